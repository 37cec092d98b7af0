"""Token counts of sections of texts, and of fields of rows, by token spans.

A whole text is encoded once. Each token covers a span of its bytes, and each section too; both
are sorted and without gaps, so their interval join is a merge of two sorted lists in the task that
holds the text, with a pair for each token and section that overlap. A token inside one section
counts there. One that crosses boundaries is allocated by a rule:

* ``first``: to the section of its first byte;
* ``last``: to the section of its last byte;
* ``most``: to the section with most of its bytes, the first one of equals;
* ``share``: to each section by its share of the token's bytes.

The first three give whole numbers, and all of them add up to the text's tokens.

Null and empty texts have one section without tokens. Every row gives its own result rows, repeated
ones too; a null id stays null. An empty field is a section without tokens. Further
columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefeed.llm.byte_bpe import default_file, encoder
from tidefeed.llm.shared import chunks, flat, utf8

RULES = ("first", "last", "most", "share")
COUNTED = (
    "section int, start long, n_bytes long, n_tokens double, n_crossing long"
)


def allocate(tokens: np.ndarray, sections: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and tokens that it has a part of only.

    ``tokens`` and ``sections`` are their bounds, one more than there are of them. Sections may be
    empty; tokens are not.
    """
    n = len(sections) - 1
    # sections that hold a token's first and last byte: empty ones hold none
    first = np.searchsorted(sections, tokens[:-1], side="right") - 1
    last = np.searchsorted(sections, tokens[1:] - 1, side="right") - 1
    crossing = first != last
    whole = np.bincount(first[~crossing], minlength=n).astype(float)
    # one pair for each section that a crossing token overlaps
    spread = last[crossing] - first[crossing] + 1
    token = np.repeat(np.flatnonzero(crossing), spread)
    within = np.arange(len(token)) - np.repeat(np.cumsum(spread) - spread, spread)
    section = np.repeat(first[crossing], spread) + within
    covered = np.minimum(tokens[token + 1], sections[section + 1]) - np.maximum(
        tokens[token], sections[section]
    )
    parts = np.bincount(section[covered > 0], minlength=n)
    if rule == "share":
        share = covered / (tokens[token + 1] - tokens[token])
        return whole + np.bincount(section, share, n), parts
    if rule == "most" and len(token):
        starts = np.cumsum(spread) - spread
        best = np.maximum.reduceat(covered, starts)
        at = np.flatnonzero(covered == np.repeat(best, spread))
        chosen = section[at[np.searchsorted(at, starts)]]
    else:
        chosen = (last if rule == "last" else first)[crossing]
    return whole + np.bincount(chosen, minlength=n), parts


def _line_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the lines of each text (a line break belongs to its line), and how many."""
    breaks = np.flatnonzero(data == 10) + 1
    counts = np.diff(np.searchsorted(breaks, offsets, side="right")) + 1
    ends = np.insert(breaks, np.searchsorted(breaks, offsets[1:], side="right"), offsets[1:])
    return ends, counts


def _counted(file: str, rule: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(file)
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for a, b in chunks(offsets):
                texts = batch.column("text").slice(a, b - a).fill_null("").to_pylist()
                at = offsets[a : b + 1] - offsets[a]
                if "ends" in batch.schema.names:
                    ends, counts = flat(batch.column("ends").slice(a, b - a))
                    ends = ends + np.repeat(at[:-1], counts)
                else:
                    ends, counts = _line_bounds(data[offsets[a] : offsets[b]], at)
                lengths = np.concatenate(
                    [np.zeros(0, np.int64), *[coder.bytes_of[coder.ids(t)] for t in texts]]
                )
                bounds = np.concatenate([[0], np.cumsum(lengths)])
                sections = np.concatenate([[0], ends])
                tokens, parts = allocate(bounds, sections, rule)
                row = np.repeat(np.arange(b - a), counts)
                first = np.cumsum(counts) - counts
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(a + row)),
                        pa.array((np.arange(len(row)) - first[row]).astype(np.int32)),
                        pa.array(sections[:-1] - at[row]),
                        pa.array(np.diff(sections)),
                        pa.array(tokens),
                        pa.array(parts.astype(np.int64)),
                    ],
                    ["id", "section", "start", "n_bytes", "n_tokens", "n_crossing"],
                )

    return count


def line_tokens(
    docs: DataFrame, id: str = "doc_id", text: str = "text", rule: str = "first",
    file: str | None = None,
) -> DataFrame:
    """(id, section, start, n_bytes, n_tokens, n_crossing) of each line of each text."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    counted = rows.mapInArrow(_counted(file or default_file(), rule), "id long, " + COUNTED)
    return counted.withColumnRenamed("id", id)


def field_tokens(
    rows: DataFrame, id: str, fields: list[str], joiner: str = "\n", rule: str = "first",
    file: str | None = None,
) -> DataFrame:
    """The same for named columns, joined and encoded as one text; a joiner belongs to the field
    before it."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    values = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    ended = [F.concat(v, F.lit(joiner)) for v in values[:-1]] + values[-1:]
    ends, total = [], F.lit(0).cast("long")
    for value in ended:
        total = total + F.octet_length(value)
        ends.append(total)
    joined = rows.select(
        F.col(id).cast("long").alias("id"), F.concat(*ended).alias("text"), F.array(*ends).alias("ends")
    )
    counted = joined.mapInArrow(_counted(file or default_file(), rule), "id long, " + COUNTED)
    name = F.get(F.array(*[F.lit(f) for f in fields]), F.col("section"))
    return counted.select(F.col("id").alias(id), name.alias("field"), "start", "n_bytes",
                          "n_tokens", "n_crossing")
