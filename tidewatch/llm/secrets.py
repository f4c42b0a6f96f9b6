"""Secrets in texts: fixed patterns, and strings that a public token vocabulary compresses badly."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tidewatch.llm.common import id_and_text, slices

#: Fixed patterns and least lengths of the base kinds.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LEAST = 6
#: One of these is in every text, lower-cased, that ASSIGN matches.
ASSIGN_WORDS = ("passw", "secret", "token", "api")
#: A run that is long enough is the whole run that the open pattern would match.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

#: Strings that the token test looks at.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: The shortest string that is tested, and what joins its parts.
LEAST = 20
PART = re.compile(r"[A-Za-z0-9]+")
UUID = re.compile(r"(?<![A-Za-z0-9])[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}(?![A-Za-z0-9])")
#: Characters a token below which a string counts as random.
RATIO = 2.0
#: Known digests (md5, sha-1, sha-224, sha-256, sha-384, sha-512 in hex) and identifiers (uuid, plain
#: numbers, words or numbers joined by one sign) are no secrets.
DIGESTS = frozenset((32, 40, 56, 64, 96, 128))
HEX_ALL = re.compile(r"[0-9a-f]+|[0-9A-F]+")
IDENTIFIER = re.compile(
    r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}|[0-9]+|(?:[A-Za-z]+|[0-9]+)(?:[+/_=-]+(?:[A-Za-z]+|[0-9]+))+[+/_=-]*"
)
#: Characters that are tokenised at a time, so the cost of a long run stays in proportion to it.
BLOCK = 512

SCHEMA = "doc_id long, spans array<struct<kind:string,begin:int,end:int>>"
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("spans", pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32())]))),
    ]
)


@lru_cache(maxsize=2)
def token_counter(ranks_path: str, pattern: str):
    """Counts tokens of a string with a tiktoken vocabulary file."""
    import base64

    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def count(text: str) -> int:
        return sum(len(encoding.encode_ordinary(text[i : i + BLOCK])) for i in range(0, len(text), BLOCK))

    return count


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(begin, kind, end)`` of the fixed patterns: leftmost matches of each kind, too short ones dropped."""
    found = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


def is_random(text: str, count, ratio: float = RATIO) -> bool:
    """Whether a run of characters is random by the token test, digests and identifiers excluded."""
    if not any(c.isalpha() for c in text):
        return False
    if len(text) in DIGESTS and HEX_ALL.fullmatch(text) or IDENTIFIER.fullmatch(text):
        return False
    return len(text) < ratio * count(text)


def heaviest(weights: list[int | float]) -> list[tuple[int, int]]:
    """All maximal stretches of positive sum, ``(begin, end)``: none grows in sum by taking in what lies beside it. Linear time."""
    found, open_, total = [], [], 0
    for i, weight in enumerate(weights):
        below, total = total, total + weight
        if weight <= 0:
            continue
        above, begin = total, i
        while True:
            while open_ and open_[-1][0] >= below:
                found.append(open_.pop()[2:])
            if not open_ or open_[-1][1] >= above:
                open_.append((below, above, begin, i + 1))
                break
            below, _, begin, _ = open_.pop()
    # What was closed before a stretch grew over it lies inside that one.
    out: list[tuple[int, int]] = []
    for begin, end in sorted(found + [x[2:] for x in open_], key=lambda x: (x[0], -x[1])):
        if not out or begin >= out[-1][1]:
            out.append((begin, end))
    return out


def random_parts(text: str, count, ratio: float = RATIO) -> list[tuple[int, int]]:
    """Random strings in a run: the whole, or else stretches of its parts between signs, or else single parts.

    A part weighs by how many tokens more it takes than a string of that length may, so a readable name or path in front of a secret
    does not hide it. Identifiers with signs inside (uuid) are not cut.
    """
    if len(text) < LEAST:
        return []
    if is_random(text, count, ratio):
        return [(0, len(text))]
    found, at = [], 0
    for begin, end in [*(m.span() for m in UUID.finditer(text)), (len(text), len(text))]:
        parts = [m.span() for m in PART.finditer(text, at, begin)]
        at = end
        weights = [ratio * count(text[i:j]) - (j - i) for i, j in parts]
        for first, last in heaviest(weights):
            i, j = parts[first][0], parts[last - 1][1]
            if j - i >= LEAST and is_random(text[i:j], count, ratio):
                found.append((i, j))
            else:
                found += [(i, j) for i, j in parts[first:last] if j - i >= LEAST and is_random(text[i:j], count, ratio)]
    return found


def all_spans(text: str, count, ratio: float = RATIO) -> list[tuple[int, int, int]]:
    """Base spans and, apart from them, random strings in the rest of each run; by begin, then kind."""
    found = base_spans(text)
    covered = sorted((begin, end) for begin, _, end in found)
    random, at, reach = [], 0, 0
    for match in CANDIDATE.finditer(text):
        begin, end = match.span()
        free = max(begin, reach)
        while at < len(covered) and covered[at][0] < end:
            if covered[at][0] > free:
                random += [(free + i, 3, free + j) for i, j in random_parts(text[free : covered[at][0]], count, ratio)]
            reach = max(reach, covered[at][1])
            free = max(free, reach)
            at += 1
        if free < end:
            random += [(free + i, 3, free + j) for i, j in random_parts(text[free:end], count, ratio)]
    return sorted(found + random)


def find_secrets(docs: DataFrame, ranks_path: str, pattern: str, ratio: float = RATIO) -> DataFrame:
    """Secrets of every whole text: ``doc_id, spans`` with ``kind, begin, end`` in code points, end exclusive.

    Kinds ``assign``, ``access`` and ``hex`` are fixed patterns. ``random`` is a string of 20 or more characters with
    letters that takes more than one token for each ``ratio`` characters of the vocabulary, is no known digest
    or identifier and lies outside the other spans: a run, what is left of it beside the other spans, or parts of it between
    signs (``random_parts``). One pass without a shuffle; a task holds a slice of texts.

    Null and empty texts give no spans. Null identifiers and repeated rows keep their rows. Other columns
    are not read. An empty table gives no rows.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = token_counter(ranks_path, pattern)
        for ids, texts in slices(batches):
            spans = [
                [{"kind": KINDS[kind], "begin": begin, "end": end} for begin, kind, end in all_spans(text, count, ratio)]
                for text in texts
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(spans, _ARROW.field("spans").type)], schema=_ARROW
            )

    return id_and_text(docs).mapInArrow(scan, SCHEMA)
