"""Secret scans by one automaton for all rules.

All rules are compiled into one table that reads every byte once and tells which rules can end
there. Texts with such an end are read a second time by the same rules compiled backwards, again all
at once, which marks the bytes where matches begin; from these bytes the rules compiled forwards tell
how far each match goes, all starts together. Matches are taken from left to right without overlap.
Base rules come first; the others add spans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tablework.llm import words as W
from tablework.llm.automaton import RESET, Table, compile_rules
from tablework.llm.shared import documents, id_and_text

_ASSIGN = "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9+/_.=-]"
# Kind, regex whose matches are taken, least length, regex that every long enough match ends with
# somewhere inside: what the common automaton looks for.
RULES = [
    ("assign", _ASSIGN + "+", 8, _ASSIGN + "{8,}"),
    ("access", "AKIA[A-Z0-9]+", 16, "AKIA[A-Z0-9]{8,}"),
    ("hex", "[0-9a-f]+", 32, "[0-9a-f]{8,}"),
    ("github", "gh[opsu]_[A-Za-z0-9]+", 40, "gh[opsu]_[A-Za-z0-9]{8,}"),
    ("slack", "xox[abprs]-[A-Za-z0-9-]+", 15, "xox[abprs]-[A-Za-z0-9-]{8,}"),
    ("private", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, "PRIVATE KEY-----"),
]
BASE = 3
VALUE_ONLY = ("assign",)  # the least length is that of the run at the end
STARTS = 1 << 18


@cache
def automata() -> tuple[Table, Table, Table]:
    """All rules in each: where long enough matches end, where matches begin (read backwards), and
    how far a match goes."""
    own = [r[1] for r in RULES]
    return (
        compile_rules([r[3] for r in RULES], anywhere=True),
        compile_rules(own, anywhere=True, backwards=True),
        compile_rules(own, anywhere=False),
    )


def suspects(
    part: W.Part, common: Table
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The part's bytes with RESET behind each row, where rows begin there, and by row a bit for each
    rule that can match: one pass for all rules."""
    buffer = np.full(len(part.data) + len(part), RESET, np.uint8)
    begins = part.offsets[:-1] + np.arange(len(part))
    row = np.repeat(np.arange(len(part)), np.diff(part.offsets))
    buffer[np.arange(len(part.data)) + row] = part.data
    ends = common.scan(buffer)
    at = np.flatnonzero(ends)
    bits = np.zeros(len(part), ends.dtype)
    np.bitwise_or.at(bits, np.searchsorted(begins, at, "right") - 1, ends[at])
    return buffer, np.append(begins, len(buffer)), bits


def spans_in(
    buffer: np.ndarray, bits: np.ndarray, compiled: tuple[Table, Table, Table]
) -> list[tuple[int, int, int]]:
    """(start, rule, end) in bytes of the leftmost matches without overlap, by rule. ``bits`` are the
    rules wanted at each byte. Matches that are too short take their bytes and are left out."""
    _, backward, forward = compiled
    begins = backward.scan(buffer[::-1])[::-1] & bits
    starts = np.flatnonzero(begins)
    found = []
    taken = np.zeros(len(RULES), np.int64)  # by rule, the end of its last match so far
    for block in range(0, len(starts), STARTS):
        own = starts[block : block + STARTS]
        open_ = [(begins[own] >> rule & 1 == 1) & (own >= taken[rule]) for rule in range(len(RULES))]
        needed = np.logical_or.reduce(open_)
        own = own[needed]
        first, last = forward.longest(buffer, own, len(RULES))
        for rule, (kind, _, least, _) in enumerate(RULES):
            mine = np.flatnonzero(open_[rule][needed])
            start, end = own[mine], last[rule, mine]
            value = first[rule, mine] - 1 if kind in VALUE_ONLY else start
            after = np.searchsorted(start, end).tolist()
            i = 0
            while i < len(start):  # one step per match
                if end[i] - value[i] >= least:
                    found.append((int(start[i]), rule, int(end[i])))
                taken[rule], i = end[i], after[i]
    return found


def row_spans(
    part: W.Part, compiled: tuple[Table, Table, Table]
) -> dict[int, list[tuple[int, int, int]]]:
    """(start, rule, end) in code points, by row that has any."""
    buffer, begins, bits = suspects(part, compiled[0])
    rows = np.flatnonzero(bits)
    if not len(rows):
        return {}
    sizes = begins[rows + 1] - begins[rows]
    own = np.concatenate([buffer[begins[r] : begins[r + 1]] for r in rows])
    at = np.append(0, np.cumsum(sizes))
    place = np.append(0, np.cumsum((own & 0xC0) != 0x80))
    found: dict[int, list[tuple[int, int, int]]] = {}
    for start, rule, end in spans_in(own, np.repeat(bits[rows], sizes), compiled):
        i = int(np.searchsorted(at, start, "right")) - 1
        zero = place[at[i]]
        span = (int(place[start] - zero), rule, int(place[end] - zero))
        found.setdefault(int(rows[i]), []).append(span)
    return found


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{RULES[rule][0]}:{start}:{end}" for start, rule, end in sorted(spans))


def _scan(compiled):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            for part in W.parts(batch.column("text")):
                counts = np.zeros((BASE, len(part)), np.int64)
                digests, texts = [nothing] * len(part), [""] * len(part)
                for row, spans in row_spans(part, compiled.value).items():
                    base = [x for x in spans if x[1] < BASE]
                    for _, rule, _ in base:
                        counts[rule, row] += 1
                    digests[row] = hashlib.sha256(_joined(base).encode()).hexdigest()
                    texts[row] = _joined(spans)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(part.first, len(part)),
                        *(pa.array(c) for c in counts), pa.array(digests), pa.array(texts),
                    ],
                    ["doc_id", *(f"n_{r[0]}" for r in RULES[:BASE]), "base_sha256", "spans"],
                )

    return scan


def secret_spans(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: counts of base matches, the digest of their spans, and all
    spans. Spans are ``kind:start:end`` in code points. A null text is empty and has none."""
    compiled = docs.sparkSession.sparkContext.broadcast(automata())  # a few hundred kilobytes
    return id_and_text(docs).mapInArrow(
        _scan(compiled),
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
    )


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(documents(spark, sf_dir))
