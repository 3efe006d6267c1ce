"""Secret scan that understands assignments in source and configuration texts.

Three fixed patterns find secrets by their form. Beyond them a lexer reads the text: strings
with escapes, triple-quoted and concatenated ones, comments, blocks of functions, typed and
keyword assignments, JSON members, INI and shell lines, YAML scalars and block scalars, XML
elements and attributes. It gives pairs of a name and a literal, or of a name and another name.

Names are looked up where they are used: in their function, then in those around it, before or
after the use. Literals flow along these links until nothing changes, so the literal in
``x = "..."`` counts as that of ``db_password = x`` as well, however long the chain. Each literal
is scored by the words in the names it reaches and by how random it looks; a random one makes up
for a vague name.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

# The base patterns and their least lengths.
_ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Runs of 32 or more: what is left of all runs of [0-9a-f] when the shorter ones are dropped.
_HEX = re.compile(r"[0-9a-f]{32,}")
_ASSIGN_LEAST, _ACCESS_LEAST = 8, 16
# Kinds in the order in which spans with one start are listed; "name" is this method's.
KINDS = ("assign", "access", "hex", "name")

# Words in target names and what they say about the literal.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "private": 0.6, "auth": 0.6, "key": 0.5,
    "pass": 0.8, "bearer": 0.9, "signature": 0.5, "salt": 0.5, "pin": 0.5, "session": 0.4, "cookie": 0.4,
}
HARMLESS = {"public", "example", "sample", "test", "dummy", "placeholder", "hash", "name", "id", "path", "file", "url"}
MIN_SCORE = 0.8
MIN_LITERAL = 8
# From which randomness on a literal is evidence of its own, and how much of it at most.
RANDOM, LIFT = 0.7, 0.72

# RE2, for whole batches: texts that can have an assignment or a base match at all.
_MAY_ASSIGN = r"[A-Za-z_][\w.\-\x{80}-\x{10FFFF}]*[\"']?[ \t]*(:=|=>|=|:)|</[A-Za-z_]"
_MAY_MATCH = r"(?i)password|passwd|secret|token|api_?key"

# What the lexer stops at. A head is a name and its operator, with a type between them or not.
_NEXT = re.compile(
    r"""(?P<line>\n(?P<indent>[ \t]*)(?P<def>(?:async[ \t]+)?def[ \t]+\w+)?(?=\S))"""
    r"""|(?P<escape>\\.)"""
    r"""|(?P<xml><(?P<tag>[A-Za-z_][\w.\-:]*)(?:\s[^<>]*)?>(?P<content>[^<>]*)</(?P=tag)\s*>)"""
    r"""|(?P<head>(?<![\w.\-])(?P<name>[A-Za-z_][\w.\-]*)["']?[ \t]*"""
    r"""(?P<op>:[ \t]*[A-Za-z_][\w.\[\]|]*[ \t]*=|:=|=>|=|:)(?![=:/>])[ \t]*)"""
    r"""|(?P<comment>(?<!\S)\#|(?<!:)//|/\*)"""
    r"""|(?P<quoted>"|(?<!\w)'|`)"""
    r"""|(?P<keyword>\b(?:if|for|while|switch|catch|else|try|function|func|fn)\b)"""
    r"""|(?P<open>(?P<body>(?:\)|=>)\s*)?\{)|(?P<close>\})"""
)
_FIRST = re.compile(r"([ \t]*)((?:async[ \t]+)?def[ \t]+\w+)?")
_FUNCTIONS = {"function", "func", "fn"}
_STRING = re.compile(
    r"""(?:[rRbBuUfF]{1,2}(?=["']))?(?:\"{3}(?P<triple>(?s:.*?))\"{3}|'{3}(?P<triple_single>(?s:.*?))'{3}"""
    r"""|"(?P<double>(?:[^"\\\n]|\\.)*)"|'(?P<single>(?:[^'\\\n]|\\.)*)'|`(?P<back>[^`\n]*)`)"""
)
_BARE = re.compile(r"""[^\s"'`,;(){}\[\]]+""")
# Between the parts of one value, on one line or, in parentheses or after an operator, on two.
_JOIN = re.compile(r"""[ \t]*(?:\\?\n[ \t]*)?(?:\+|\.{1,2}|&)\s*|[ \t]+(?:\\\n[ \t]*)?(?=["'])""")
_JOIN_WITHIN = re.compile(r"""\s*(?:(?:\+|\.{1,2}|&)\s*|(?=["']))""")
_OPENING = re.compile(r"\(\s*")
_BLOCK = re.compile(r"[|>][+\-0-9]{0,2}[ \t]*\n")
_BLOCK_LINE = re.compile(r"([ \t]*)([^\n]*)(?:\n|\Z)")
_IDENTIFIER = re.compile(r"[A-Za-z_][\w.]*\Z")
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns' matches."""
    spans = []
    for m in _ASSIGN.finditer(text):
        if len(m[2]) >= _ASSIGN_LEAST:
            spans.append((m.start(), m.end(), "assign"))
    for m in _ACCESS.finditer(text):
        if m.end() - m.start() >= _ACCESS_LEAST:
            spans.append((m.start(), m.end(), "access"))
    for m in _HEX.finditer(text):
        spans.append((m.start(), m.end(), "hex"))
    return spans


def name_score(name: str) -> float:
    """How sensitive a target name sounds, by its words: 0 to 1."""
    words = [w.lower() for w in _WORD.findall(name)]
    joined = {a + b for a, b in zip(words, words[1:])}
    best = max((SENSITIVE.get(w, 0.0) for w in [*words, *joined]), default=0.0)
    return best * (0.5 if HARMLESS & set(words) else 1.0)


def randomness(literal: str) -> float:
    """0 to 1: bits per character of the literal's own distribution, and kinds of characters."""
    n = len(literal)
    bits = -sum(c / n * math.log2(c / n) for c in Counter(literal).values())
    kinds = sum(any(test(c) for c in literal) for test in (str.islower, str.isupper, str.isdigit))
    kinds += any(not c.isalnum() for c in literal)
    return min(1.0, bits / 4) * (0.5 + 0.5 * min(1.0, (kinds - 1) / 2))


def score(named: float, random: float) -> float:
    """How likely a literal of this randomness is a secret, when its best name scores ``named``.

    A random literal counts beside the name, so every word of SENSITIVE can reach MIN_SCORE;
    one of a weight below 0.3 can't, such as ``key`` in a harmless name.
    """
    plain = named * (0.6 + 0.4 * random)
    return max(plain, 1 - (1 - named) * (1 - LIFT * random)) if named and random >= RANDOM else plain


# Parts of a literal: the (start, end) of each string or line that it is put together from.
Parts = list[tuple[int, int]]


def _lines(text: str, start: int, end: int) -> Parts:
    """The non-blank lines between two places, without the white space around them."""
    return [(start + m.start(), start + m.end()) for m in re.finditer(r"[^\s](?:[^\n]*[^\s])?", text[start:end])]


def _block_scalar(text: str, at: int, indent: int) -> Parts:
    """The lines from ``at`` on that stand deeper than ``indent``."""
    end = start = at
    while end < len(text):
        m = _BLOCK_LINE.match(text, end)
        if m[2].strip() and len(m[1]) <= indent:
            break
        end = m.end()
    return _lines(text, start, end)


def _value(text: str, at: int) -> tuple[list[Parts], list[tuple[str, int]], int]:
    """What stands right of an operator: literals, names with their places, and the end."""
    opening = _OPENING.match(text, at)
    join = _JOIN_WITHIN if opening else _JOIN
    at = opening.end() if opening else at
    literals: list[Parts] = []
    names: list[tuple[str, int]] = []
    joined = False  # the part before was a string
    end = at
    while True:
        if m := _STRING.match(text, at):
            start, stop = m.span(m.lastgroup)
            parts = _lines(text, start, stop) if m.lastgroup.startswith("triple") else [(start, stop)]
            if joined:
                literals[-1].extend(parts)
            else:
                literals.append(parts)
            joined = True
        elif m := _BARE.match(text, at):
            value, stop = m[0], m.end()
            if value.endswith("+") and _IDENTIFIER.match(value[:-1]) and text[stop : stop + 1] in ('"', "'"):
                names.append((value[:-1], at))
                joined, at = False, stop
                continue
            if literals or names:  # after an operator only a name can follow
                if not _IDENTIFIER.match(value):
                    break
                names.append((value, at))
            elif _IDENTIFIER.match(value):
                names.append((value, at))
            else:
                return [[(at, stop)]], [], stop
            joined = False
        else:
            break
        end = m.end()
        m = join.match(text, end)
        if m is None or m.end() == end and not opening:
            break
        at = m.end()
    return literals, names, end


def _pairs(text: str) -> tuple[list[tuple[int, str, list[Parts], list[tuple[str, int]]]], list[int]]:
    """(scope, name, literals, names with places) of each assignment, and each scope's parent."""
    pairs = []
    parents = [-1]
    stack: list[tuple[str, int, int]] = []  # kind, indent, scope
    scope, pos, quiet, braces, keyword = 0, 0, 0, 0, ""
    first = _FIRST.match(text)
    indent = len(first[1])
    if first[2]:
        parents, scope, pos = [-1, 0], 1, first.end()
        stack.append(("def", indent, scope))
    while m := _NEXT.search(text, pos):
        kind = next(k for k in ("line", "escape", "xml", "head", "comment", "quoted", "keyword", "open", "close") if m[k] is not None)
        pos, heard = m.end(), m.start() >= quiet
        if kind == "head":
            block = _BLOCK.match(text, pos) if m["op"] == ":" else None
            if block:
                pairs.append((scope, m["name"], [_block_scalar(text, block.end(), indent)], []))
                pos = block.end() - 1  # what stands in the block may assign as well
            else:
                literals, names, end = _value(text, pos)
                if literals or names:
                    pairs.append((scope, m["name"], literals, names))
                    pos = end
        elif kind == "xml":
            pairs.append((scope, m["tag"], [_lines(text, *m.span("content"))], []))
            pos = m.start("tag")
        elif kind == "line":
            indent = len(m["indent"])
            if not heard:
                continue
            while stack and stack[-1][0] == "def" and stack[-1][1] >= indent:
                stack.pop()
            scope = stack[-1][2] if stack else 0
            if m["def"]:
                parents.append(scope)
                scope = len(parents) - 1
                stack.append(("def", indent, scope))
        elif not heard:
            continue
        elif kind == "comment":  # no blocks in it, but maybe assignments
            quiet = text.find("*/" if m[kind] == "/*" else "\n", pos)
            quiet = len(text) if quiet < 0 else quiet
        elif kind == "quoted":
            string = _STRING.match(text, m.start())
            quiet = string.end() if string else pos
        elif kind == "keyword":
            keyword = m[kind]
        elif kind == "open":
            if (m["body"] and not keyword) or keyword in _FUNCTIONS:
                parents.append(scope)
                scope = len(parents) - 1
            stack.append(("brace", indent, scope))
            braces += 1
            keyword = ""
        elif kind == "close":
            if braces:
                while stack.pop()[0] != "brace":
                    pass
                braces -= 1
                scope = stack[-1][2] if stack else 0
            keyword = ""
    return pairs, parents


def assigned_spans(text: str, min_score: float = MIN_SCORE) -> list[tuple[int, int, str]]:
    """(start, end, "name") of literals that reach a sensitive name and look like a secret.

    A literal put together from several strings or lines is judged as a whole, and each of its
    parts is a span. A name without a literal anywhere in sight stands for itself, as an unquoted
    value. Strings and comments are searched for assignments too.
    """
    pairs, parents = _pairs(text)
    # a name with a dot belongs to an object, whatever function sets it
    keys = dict.fromkeys((0 if "." in name else scope, name) for scope, name, *_ in pairs)
    node = {key: i for i, key in enumerate(keys)}

    def looked_up(name: str, scope: int) -> int | None:
        scope = 0 if "." in name else scope
        while scope >= 0 and (scope, name) not in node:
            scope = parents[scope]
        return node.get((scope, name))

    scores = [name_score(name) for _, name in node]
    sources: list[list[int]] = [[] for _ in node]  # the names that flow into each
    literals: list[tuple[Parts, int]] = []
    for scope, name, parts, names in pairs:
        target = node[0 if "." in name else scope, name]
        literals += [(p, target) for p in parts]
        for i, (other, at) in enumerate(names):
            source = looked_up(other, scope)
            if source is not None and source != target:
                sources[target].append(source)
            elif i == 0 and not parts:
                literals.append(([(at, at + len(other))], target))
    # the highest score of all names that a name flows into, the highest first, so each is set once
    best = [-1.0] * len(scores)
    for start in sorted(range(len(scores)), key=lambda i: -scores[i]):
        todo = [start] if best[start] < 0 else []
        while todo:
            i = todo.pop()
            if best[i] < 0:
                best[i] = scores[start]
                todo += sources[i]
    spans = set()
    for parts, target in literals:
        value = "".join(text[a:b] for a, b in parts)
        if len(value) < MIN_LITERAL or any(c.isspace() for c in value):
            continue
        random = randomness(value)
        if random >= 0.5 and score(best[target], random) >= min_score:
            spans.update((a, b, "name") for a, b in parts if b > a)
    return sorted(spans)


def listed(spans: list[tuple[int, int, str]]) -> str:
    """kind:start:end by start, then by the order of kinds."""
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ordered)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(1).fill_null("")
        may = pc.or_(
            pc.or_(pc.match_substring_regex(column, _MAY_MATCH), pc.match_substring(column, "AKIA")),
            pc.match_substring_regex(column, "[0-9a-f]{32}"),
        ).to_numpy(zero_copy_only=False)
        assigns = pc.match_substring_regex(column, _MAY_ASSIGN).to_numpy(zero_copy_only=False)
        rows = []
        for text, base, more in zip(column, may, assigns):
            if not base and not more:
                rows.append((0, 0, 0, _EMPTY, ""))
                continue
            text = text.as_py()
            found = base_spans(text) if base else []
            n = Counter(kind for _, _, kind in found)
            every = listed(found + (assigned_spans(text) if more else []))
            digest = sha256(listed(found).encode()).hexdigest()
            rows.append((n["assign"], n["access"], n["hex"], digest, every))
        columns = list(zip(*rows)) if rows else [()] * 5
        types = [pa.int64()] * 3 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        )


_EMPTY = sha256(b"").hexdigest()


def secret_spans(docs: DataFrame) -> DataFrame:
    """Secrets of every row of ``docs`` (doc_id, text, ...).

    Gives doc_id, n_assign, n_access, n_hex (matches of the fixed patterns), base_sha256 (of
    their list) and spans: all spans as kind:start:end in code points, the end exclusive. A
    null or empty text has none. Repeated rows are scanned each; other columns are ignored.
    """
    return docs.select("doc_id", "text").mapInArrow(
        _scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )
