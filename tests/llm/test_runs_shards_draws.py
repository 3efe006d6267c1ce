"""Periodic runs, slot sharding and importance resampling against brute force and their SQL."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.llm import importance_resampling, periodic_runs, slot_sharding
from tidepool.llm.queries import oracle_sql, queries

SMALL = "/root/testdata/sf0.001"
SPACED = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# longer than a part of a batch (256 KB) by itself
LONG = " ".join(f"w{k % 9973}" for k in range(60_000)) + " tail" * 40

ODD = [
    None, "", " \n\t ", "...", "word", "a a a a a", "a a a a a a", "WORD word WORD", LONG, "x y " * 9, "x y " * 9, "\t été\x0bà été à\r\nété à\xa0été à été",
    "日本 語 " * 8 + "文", "p q r " * 4 + "p q", "one two three four five six seven eight nine ten " * 3, "b b b b b b c c c c c c c b b b b b b",
    " ".join("abcdefghijklmnopqrstuvwxyz"), "x\x00y " * 6,
]
SCHEMA = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    out = spark.createDataFrame([(i, t, None) for i, t in enumerate(ODD)], SCHEMA)
    for name in ("runs", "_words", "_", "collapsed", "shard", "slot", "virtual_slot", "bucket", "score", "rank", "weight", "n", "_range", "_before"):
        out = out.withColumn(name, F.lit("extra"))
    return out


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def repeated(spark):
    """Repeated rows, ids with several texts and rows without an id."""
    texts = ["x y " * 9, None, "tail " * 30, "x y " * 9, "one two", ""]
    rows = [(i, t, "en") for i, t in zip([1, 1, 2, 1, None, None], texts)]
    return spark.createDataFrame(rows * 2, SCHEMA)


def rows_of(df):
    return sorted(map(repr, df.collect()))


# -- 11 -----------------------------------------------------------------------------------


def brute_runs(w, min_length=6, min_exponent=4):
    """From the definition: every period, every stretch that can't grow, no smaller period."""
    out = []
    for q in range(1, len(w) // min_exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            stretch = w[i : i + length]
            if length >= max(min_length, min_exponent * q) and not any(
                all(a == b for a, b in zip(stretch, stretch[p:])) for p in range(1, q)
            ):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("limits", [(6, 4), (2, 2), (4, 3), (1, 2), (9, 2)])
def test_runs_of_random_sequences(limits):
    random = np.random.default_rng(sum(limits))
    for turn in range(300):
        if turn % 2:
            codes = random.integers(0, random.integers(1, 4), random.integers(0, 50))
        else:
            parts = [np.tile(random.integers(0, 3, random.integers(1, 5)), random.integers(1, 7)) for _ in range(random.integers(1, 5))]
            codes = np.concatenate(parts)
        assert periodic_runs.find_runs(codes.astype(np.int64), *limits) == brute_runs(codes.tolist(), *limits)


def test_large_classes_are_split_into_blocks():
    assert periodic_runs.find_runs(np.zeros(20_000, dtype=np.int64)) == [(0, 20_000, 1)]
    tiled = np.tile(np.random.default_rng(3).integers(0, 10**9, 3), 5_000)
    assert periodic_runs.find_runs(tiled) == [(0, 15_000, 3)]
    left = periodic_runs.Positions(0)
    for p in range(2, 9_000, 2):
        left.add(p)
    assert len(left.blocks) > 1 and list(left) == list(range(0, 9_000, 2))
    right = periodic_runs.Positions(4_001)
    right.add(4_003)
    right.add(20_001)
    assert left.unite(right) == [(4_000, 4_001), (4_001, 4_002), (4_002, 4_003), (4_003, 4_004), (8_998, 20_001)]


def planted(doc_id, text):
    w = re.findall(SPACED, text or "")
    h = crc32(str(doc_id).encode())
    n = len(w)
    if h % 10 == 0 and n and doc_id is not None:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    return w


def brute_row(doc_id, w):
    # periods of the long text are known: its words repeat after 9973, then one word does
    found = brute_runs(w) if len(w) < 3_000 else brute_long(w)
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    gone = {at for s, n, q in found for at in range(s + q, s + n)}
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return doc_id, len(found), *best, milli, digest(listed), digest(kept)


def brute_long(w):
    out = []
    for q in sorted({1, 9973} | {p for p in range(2, 40)}):
        same = [a == b for a, b in zip(w, w[q:])]
        i = 0
        while i < len(same):
            j = i
            while j < len(same) and same[j]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                out.append((i, j - i + q, q))
            i = j + 1
    inner = lambda r, s: s[2] < r[2] and s[0] <= r[0] and s[0] + s[1] >= r[0] + r[1]
    return sorted((r for r in out if not any(inner(r, s) for s in out)), key=lambda r: (r[0], r[2]))


def test_periodic_runs_query(spark, docs, odd, nothing, repeated, tmp_path):
    from tidepool.llm.queries import op11_periodic_runs

    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    for k, rows in enumerate((docs, odd, nothing, repeated)):
        rows.write.parquet(f"{tmp_path}/{k}/documents.parquet")
        got = [tuple(r) for r in op11_periodic_runs(spark, f"{tmp_path}/{k}").select(names).collect()]
        expected = [brute_row(r["doc_id"], planted(r["doc_id"], r["text"])) for r in rows.select("doc_id", "text").collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_planting_keeps_columns_and_other_texts(odd):
    out = periodic_runs.with_planted_runs(odd)
    assert out.columns == odd.columns
    for r in out.select("doc_id", "text", "_words").collect():
        assert r["_words"] == "extra"
        if crc32(str(r["doc_id"]).encode()) % 10 or not re.findall(SPACED, ODD[r["doc_id"]] or ""):
            assert r["text"] == ODD[r["doc_id"]]
        else:
            assert r["text"].split(" ") == planted(r["doc_id"], ODD[r["doc_id"]])


def test_exponent_below_two_is_refused(docs):
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(docs, min_exponent=1)


# -- 12 -----------------------------------------------------------------------------------


def brute_slot(doc_id, text, slots):
    key = f"{'' if doc_id is None else doc_id}:{crc32((text or '').encode())}"
    return int(hashlib.md5(key.encode()).hexdigest()[:8], 16) % slots


@pytest.mark.parametrize("which", ["docs", "odd", "nothing", "repeated"])
@pytest.mark.parametrize("slots", [slot_sharding.SLOTS, 24])
def test_shards_hold_every_record_once(spark, request, which, slots, tmp_path):
    rows = request.getfixturevalue(which)
    stored = slot_sharding.shard(rows, str(tmp_path), 3, slots)
    kept = [c for c in rows.columns if c not in ("shard", "slot", "virtual_slot")]
    assert rows_of(stored.select(kept)) == rows_of(rows.select(kept))
    places = stored.select("doc_id", "text", "shard", "slot", "virtual_slot").collect()
    owner = slot_sharding.load_map(spark, f"{tmp_path}/map")
    for shard in range(3):
        own = sorted((r for r in places if r["shard"] == shard), key=lambda r: r["slot"])
        assert [r["slot"] for r in own] == list(range(len(own)))
        order = [(r["virtual_slot"], r["doc_id"] is not None, r["doc_id"] or 0) for r in own]
        assert order == sorted(order)
    for r in places:
        assert r["virtual_slot"] == brute_slot(r["doc_id"], r["text"], slots)
        assert r["shard"] == owner[r["virtual_slot"]]


def test_shards_are_near_equal_and_the_map_has_versions(spark, docs, tmp_path):
    stored = slot_sharding.shard(docs, str(tmp_path), 4)
    loads = [r["b"] for r in stored.groupBy("shard").agg(F.sum(slot_sharding.record_size()).alias("b")).collect()]
    assert len(loads) == 4 and max(loads) - min(loads) < 0.01 * sum(loads)
    assert slot_sharding.versions(spark, f"{tmp_path}/map") == [1, 2]
    assert (slot_sharding.load_map(spark, f"{tmp_path}/map", 1) == slot_sharding.dealt(shards=4)).all()
    # again over the same records: nothing to move
    slot_sharding.shard(docs, str(tmp_path), 4)
    assert slot_sharding.versions(spark, f"{tmp_path}/map") == [1, 2, 3]
    second, third = (slot_sharding.load_map(spark, f"{tmp_path}/map", v) for v in (2, 3))
    assert (second == third).all()
    # a version without the committer's mark doesn't count
    (tmp_path / "map" / "version=9").mkdir()
    assert slot_sharding.versions(spark, f"{tmp_path}/map") == [1, 2, 3]


def test_rebalancing_moves_few_slots():
    size = np.random.default_rng(1).integers(0, 1000, 4096)
    owner = slot_sharding.rebalanced(slot_sharding.dealt(), size, 8)
    grown = slot_sharding.rebalanced(owner, size, 9)
    moved = grown != owner
    assert 0.95 < size[moved].sum() / (size.sum() / 9) < 1.1 and (grown[moved] == 8).mean() > 0.9
    shrunk = slot_sharding.rebalanced(grown, size, 8)
    assert shrunk.max() == 7 and (shrunk[grown < 8] == grown[grown < 8]).mean() > 0.98
    for one, shards in ((owner, 8), (grown, 9), (shrunk, 8)):
        loads = np.bincount(one, size, shards)
        own = size[(one == loads.argmax()) & (size > 0)]
        assert loads.max() - loads.min() < 2 * own.min() < 0.002 * loads.mean()
    assert (slot_sharding.rebalanced(owner, size, 8) == owner).all()
    assert (slot_sharding.rebalanced(owner, np.zeros(4096, dtype=np.int64), 8) == owner).all()


# -- 13 -----------------------------------------------------------------------------------


def brute_draw(docs, target, max_run=1, buckets=10_000, percent=10, min_words=20, seed=2024):
    def features(text):
        w = re.findall(ALNUM, (text or "").translate(FOLD))
        runs = [" ".join(w[i : i + k]) for k in range(1, max_run + 1) for i in range(len(w) - k + 1)]
        return len(w), [crc32(f.encode()) % buckets for f in runs]

    of = [(i, *features(t)) for i, t in docs]
    s, t = Counter(b for _, _, f in of for b in f), Counter(b for x in target for b in features(x)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    rows = []
    for i, n, f in of:
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[: percent * len(able) // 100], 1):
        r[5] = rank
    return [tuple(r) for r in rows]


@pytest.mark.parametrize("which", ["docs", "odd", "nothing", "repeated"])
@pytest.mark.parametrize("limits", [{}, {"max_run": 3, "buckets": 97, "percent": 60, "min_words": 3}])
def test_resampling(spark, request, which, limits):
    rows = request.getfixturevalue(which)
    target = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    got = importance_resampling.resampled(rows, target, **limits)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    expected = brute_draw(
        [(r["doc_id"], r["text"]) for r in rows.select("doc_id", "text").collect()],
        [r["text"] for r in target.collect()],
        **limits,
    )
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected))


def test_resampling_without_target(docs, nothing):
    got = importance_resampling.resampled(docs, nothing)
    expected = brute_draw([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], [])
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected))


def test_runs_go_on_over_parts_of_a_text(monkeypatch):
    texts = [b"a b c d e f", b"", b"g h", b"A-b;c"]
    whole = Counter()
    for size in (1 << 16, 1, 2, 3):
        monkeypatch.setattr(importance_resampling, "_WORDS", size)
        found = Counter()
        for length, of, buckets in importance_resampling._features(texts, 3, importance_resampling._Buckets(10**6)):
            found.update((length, a, b) for a, b in zip(of.tolist(), buckets.tolist()))
        whole = whole or found
        assert found == whole and sum(found.values()) == 6 + 5 + 4 + 2 + 1 + 3 + 2 + 1


# -- all ----------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op11_periodic_runs", "op12_slot_sharding", "op13_importance_resampling"])
def test_queries_and_their_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS FROM '{SMALL}/{table}.parquet'")
    df = queries()[name](spark, SMALL)
    found = con.sql(oracle_sql()[name]).to_arrow_table()
    got = df.toArrow()
    names = sorted(found.column_names)
    assert names == sorted(df.columns)
    assert {n: got.schema.field(n).type for n in names} == {n: found.schema.field(n).type for n in names}
    assert sorted(map(repr, got.select(names).to_pylist())) == sorted(map(repr, found.select(names).to_pylist()))
