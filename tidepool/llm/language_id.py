"""Language identification by prediction by partial matching.

Each language has a context tree over bytes: how often each byte followed each context of 0
to 3 bytes. A byte that was never seen after a context costs an escape to the next shorter
one; below the empty context all 256 bytes are alike. With the statistics frozen after
training, the code length of a byte depends on the byte and its context only. A text belongs
to the language that codes it in the fewest bits.

Escapes follow method C: in a context seen n times with d different bytes, a byte seen c
times has probability c / (n + d), and the escape d / (n + d). Bytes of the longer context
are not excluded after an escape.

Every language of the labelled texts is learned. The trees' sizes follow the sampled texts of
their own languages. Languages whose trees are too large for one broadcast together are held
in blocks: each block scores all texts, and the best code lengths of a text are combined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written
from .tables import in_arrow, joined, keyed
from .text import LETTERS, pieces, text_bytes

ORDER = 3
# About so many training documents of each language, chosen by a hash of the id.
TRAIN_DOCS = 20_000
# The languages of a block, and its table of code lengths: nodes times languages. A language
# with more nodes is a block of its own.
BLOCK_LANGUAGES = 64
BLOCK_CELLS = 8_000_000
MIN_SCORE = 0.5
UNKNOWN = "und"

_SPACE = 0x20
_PLAIN = np.where(LETTERS, np.arange(256), _SPACE).astype(np.uint8)


def _normal(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end, codes, offsets): lower case, each run of other bytes one space.

    A code is a byte with the three before it; texts are preceded by spaces.
    """
    data, offsets = text_bytes(pc.utf8_lower(column.cast(pa.string())))
    for first, last in pieces(offsets):
        part = _PLAIN[data[offsets[first] : offsets[last]]]
        starts = offsets[first : last + 1] - offsets[first]
        space = part == _SPACE
        keep = ~space
        keep[1:] |= ~space[:-1]
        at = starts[:-1][np.diff(starts) > 0]
        keep[at] = ~space[at]
        kept = np.r_[0, np.cumsum(keep)]
        bytes_ = part[keep].astype(np.uint32)
        where = kept[starts]
        code = bytes_.copy()
        for back in range(1, ORDER + 1):
            before = np.full(len(bytes_), _SPACE, dtype=np.uint32)
            before[back:] = bytes_[: max(len(bytes_) - back, 0)]
            for near in range(back):  # the first bytes of each text
                edge = where[:-1] + near
                before[edge[edge < where[1:]]] = _SPACE
            code |= before << np.uint32(8 * back)
        yield first, last, code, where


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, language number) to counts of codes of ORDER + 1 bytes."""
    for batch in batches:
        tongue = batch.column(1).to_numpy(zero_copy_only=False)
        for first, last, code, where in _normal(batch.column(0)):
            keys = (np.repeat(tongue[first:last], np.diff(where)).astype(np.uint64) << np.uint64(32)) | code
            grams, n = np.unique(keys, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((grams >> np.uint64(32)).astype(np.int32)),
                    pa.array((grams & np.uint64(0xFFFFFFFF)).astype(np.int64)),
                    pa.array(n.astype(np.int64)),
                ],
                names=["tongue", "gram", "n"],
            )


class Trees:
    """The frozen context trees of a block of languages, as tables of code lengths.

    A language's code lengths don't depend on the others of its block.
    """

    def __init__(self, languages: list[str], tongue: np.ndarray, gram: np.ndarray, n: np.ndarray):
        self.languages = languages
        many = len(languages)
        self.grams: list[np.ndarray] = []  # by context length: grams seen, with their code lengths
        self.bits: list[np.ndarray] = []
        self.contexts: list[np.ndarray] = []  # contexts seen, with the cost of the escape
        self.escapes: list[np.ndarray] = []
        for order in range(ORDER + 1):
            seen, at = np.unique(gram & ((1 << 8 * (order + 1)) - 1), return_inverse=True)
            counts = np.zeros((len(seen), many))
            np.add.at(counts, (at, tongue), n)
            # the context of a gram is its bytes but the last, which is the lowest
            contexts, of = np.unique(seen >> 8, return_inverse=True)
            total = np.zeros((len(contexts), many))
            kinds = np.zeros((len(contexts), many))
            np.add.at(total, of, counts)
            np.add.at(kinds, of, counts > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, np.log2((total + kinds) / kinds), 0.0)
                bits = np.log2((total + kinds)[of] / counts)
            shorter = self._lookup(order - 1, seen & ((1 << 8 * order) - 1)) if order else np.float32(8)
            escape = escape.astype(np.float32)
            bits = np.where(counts > 0, bits.astype(np.float32), escape[of] + shorter)
            self.grams.append(seen)
            self.bits.append(bits)
            self.contexts.append(contexts)
            self.escapes.append(escape)

    def _lookup(self, order: int, gram: np.ndarray) -> np.ndarray:
        """Bits of each gram's last byte after its context, in each language."""
        if order < 0 or not len(self.grams[order]):
            return np.full((len(gram), len(self.languages)), 8.0, dtype=np.float32)
        at = np.minimum(np.searchsorted(self.grams[order], gram), len(self.grams[order]) - 1)
        out = self.bits[order][at]
        new = np.flatnonzero(self.grams[order][at] != gram)
        if len(new):
            context = gram[new] >> 8
            where = np.minimum(np.searchsorted(self.contexts[order], context), len(self.contexts[order]) - 1)
            known = (self.contexts[order][where] == context)[:, None]
            escape = np.where(known, self.escapes[order][where], np.float32(0))
            out[new] = escape + self._lookup(order - 1, gram[new] & ((1 << 8 * order) - 1))
        return out

    def code_lengths(self, code: np.ndarray, where: np.ndarray) -> np.ndarray:
        """Bits of each text in each language."""
        grams, at = np.unique(code, return_inverse=True)
        bits = self._lookup(ORDER, grams.astype(np.int64))[at]
        out = np.zeros((len(where) - 1, len(self.languages)))
        filled = np.flatnonzero(np.diff(where))
        if len(filled):
            out[filled] = np.add.reduceat(bits, where[filled], axis=0, dtype=np.float64)
        return out


class Forest:
    """The trees of all languages, in blocks that are built one at a time from stored counts."""

    def __init__(self, languages: list[str], counts: DataFrame, blocks: list[range]):
        self.languages, self.counts, self.blocks = languages, counts, blocks
        self._held: list[Broadcast] = []

    def trees(self, block: range) -> Trees:
        rows = self.counts.where(F.col("tongue").between(block.start, block.stop - 1)).toArrow()
        tongue, gram, n = (rows[c].to_numpy() for c in ("tongue", "gram", "n"))
        return Trees(self.languages[block.start : block.stop], tongue - block.start, gram, n)

    def held(self) -> list[Broadcast]:
        """The blocks' trees as broadcasts; the driver keeps none in memory."""
        if not self._held:
            context = self.counts.sparkSession.sparkContext
            self._held = [context.broadcast(self.trees(block)) for block in self.blocks]
        return self._held

    def release(self) -> None:
        """Take the broadcasts from the executors; they are sent again when they are used again."""
        for block in self._held:
            block.unpersist()

    def code_lengths(self, code: np.ndarray, where: np.ndarray) -> np.ndarray:
        """Bits of each text in each language."""
        return np.hstack([self.trees(block).code_lengths(code, where) for block in self.blocks])


def _blocks(nodes: list[int], languages: int, cells: int) -> list[range]:
    """Consecutive languages, by their numbers of nodes, in blocks of bounded size."""
    blocks, first, total = [], 0, 0
    for k, n in enumerate(nodes):
        many = k - first + 1
        if many > 1 and (many > languages or many * (total + n) > cells):
            blocks.append(range(first, k))
            first, total = k, 0
        total += n
    return [*blocks, range(first, len(nodes))]


def train(
    docs: DataFrame,
    docs_per_language: int = TRAIN_DOCS,
    block_languages: int = BLOCK_LANGUAGES,
    block_cells: int = BLOCK_CELLS,
) -> Forest | None:
    """Trees from (doc_id, text, lang); None when no row has both a text and a language."""
    docs = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    sizes = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    sizes = sorted((r["lang"], r["n"]) for r in sizes)
    if not sizes:
        return None
    chosen = docs.sparkSession.createDataFrame(
        [(lang, k, min(1.0, docs_per_language / n)) for k, (lang, n) in enumerate(sizes)],
        "lang string, tongue int, share double",
    )
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    sample = joined(docs, chosen, "lang", "inner", len(sizes)).where(draw < F.col("share"))
    counts = in_arrow(sample.select("text", "tongue"), _count, "tongue int, gram long, n long")
    counts = written(counts.groupBy("tongue", "gram").agg(F.sum("n").alias("n")))
    nodes = {r["tongue"]: r["count"] for r in counts.groupBy("tongue").count().collect()}
    if not nodes:
        return None
    blocks = _blocks([nodes.get(k, 0) for k in range(len(sizes))], block_languages, block_cells)
    return Forest([lang for lang, _ in sizes], counts, blocks)


def _measured(column: pa.Array, trees: Trees | None) -> tuple[list[str | None], np.ndarray, np.ndarray]:
    """Of each text: the best language (None without a letter), its bits, and the sum of all odds against it."""
    size = len(column)
    best, bits, odds = np.zeros(size, dtype=np.int64), np.zeros(size), np.ones(size)
    letters = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
    for first, last, code, where in _normal(column) if trees else ():
        lengths = trees.code_lengths(code, where)
        best[first:last] = lengths.argmin(axis=1)
        bits[first:last] = lengths.min(axis=1)
        odds[first:last] = np.exp2(np.clip(bits[first:last, None] - lengths, -1000, 0)).sum(axis=1)
    return [trees.languages[k] if ok and trees else None for k, ok in zip(best, letters)], bits, odds


def _predict(batches: Iterator[pa.RecordBatch], trees: Trees | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        best, _, odds = _measured(batch.column(1), trees)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([UNKNOWN if x is None else x for x in best], pa.string()),
                pa.array(np.where([x is not None for x in best], 1 / odds, 0.0)),
            ],
            names=["doc_id", "lang_pred", "score"],
        )


def _score_block(batches: Iterator[pa.RecordBatch], trees: Trees) -> Iterator[pa.RecordBatch]:
    """(_row, doc_id, text) to the best language of a block, its bits and the sum of odds."""
    for batch in batches:
        best, bits, odds = _measured(batch.column(2), trees)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(best, pa.string()), pa.array(bits), pa.array(odds)],
            names=["_row", "doc_id", "lang", "bits", "odds"],
        )


def _combined(docs: DataFrame, held: list[Broadcast]) -> DataFrame:
    """As ``_predict``, from the best of each block."""
    rows, every = keyed(docs, "doc_id", "text"), None
    for block in held:
        part = in_arrow(
            rows,
            lambda b, block=block: _score_block(b, block.value),
            "_row long, doc_id long, lang string, bits double, odds double",
        )
        every = part if every is None else every.union(part)
    best = every.groupBy("_row").agg(
        F.first("doc_id").alias("doc_id"),
        F.min(F.struct("bits", "lang")).alias("best"),
        F.collect_list(F.struct("bits", "odds")).alias("blocks"),
    )
    least, lang = F.col("best.bits"), F.col("best.lang")
    odds = F.aggregate(
        "blocks",
        F.lit(0.0),
        lambda total, x: total + x["odds"] * F.pow(F.lit(2.0), F.greatest(least - x["bits"], F.lit(-1000.0))),
    )
    return best.select(
        "doc_id",
        F.coalesce(lang, F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(lang.isNull(), 0.0).otherwise(1 / odds).alias("score"),
    )


def predict(docs: DataFrame, trees: Forest | None) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs`` (doc_id, text, ...).

    The score is the probability of the language given the text when all are equally likely
    beforehand. A null text, one without a letter, and any text when there are no trees get
    ``und`` and 0. Of equally good languages the first by name is taken. Repeated rows are
    predicted each; other columns are ignored.
    """
    held = trees.held() if trees else [docs.sparkSession.sparkContext.broadcast(None)]
    if len(held) > 1:
        return _combined(docs, held)
    return in_arrow(
        docs.select("doc_id", "text"),
        lambda b: _predict(b, held[0].value),
        "doc_id long, lang_pred string, score double",
    )


def keep_identified(docs: DataFrame, trees: Forest | None, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` without rows of no known language, or of one with a score below the minimum.

    The score compares the learned languages with each other, and all but a few bytes of text
    settle it near 1. So what goes is texts without a letter and near ties; a text in a language
    that wasn't learned, or letters without meaning, stays under the nearest language.
    """
    out = written(predict(docs, trees).where((F.col("lang_pred") == UNKNOWN) | (F.col("score") < min_score)))
    if trees:
        trees.release()
    return joined(docs, out.select("doc_id"), "doc_id", "left_anti", out.count())
