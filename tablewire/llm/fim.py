"""Fill-in-the-middle transformation of texts (operator 11).

A text is cut into lines, ``[^\\n]*\\n|[^\\n]+``. Two cuts between lines, drawn from a
hash of the seed and the key alone, give prefix, middle and suffix; sentinels mark
them in the order of the form:

    psm   <P>prefix<S>suffix<M>middle
    spm   <S>suffix<P>prefix<M>middle
    plain the text as it is

The hash is computed by Spark, the text work is a pipeline of ``pyarrow.compute``
over slices of a batch: lists of lines, flattened with the number of their row,
an ordinal per line, a filter per role, lists again, and joins. A slice holds at
most a few megabytes of text, or one longer text. Rows meet no other row, so
there is no shuffle and nothing that a frequent key could make uneven.

Defined cases: a null text counts as empty, and an empty text is plain with no
lines; a text that holds a sentinel is plain; a null key is hashed as the empty
text; repeated rows come out repeatedly and alike; an empty table gives no rows;
columns other than key and text are not looked at, whatever their names. Control
characters other than the line feed do not end a line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewire.llm.shared import bounded_slices

# fixed values: sentinels of prefix, suffix and middle
SENTINELS = ("<P>", "<S>", "<M>")

OUT = "key long, n long, form string, prefix_chars long, middle_chars long, output string"


def _remainder(number: pa.Array, divisor) -> pa.Array:
    return pc.subtract(number, pc.multiply(pc.divide(number, divisor), divisor))


def transformed(batch: pa.RecordBatch, rate: int, spm_rate: int) -> pa.RecordBatch:
    """The rows of ``(key, text, h1, h2, h3, h4)`` in their forms."""
    rows = batch.num_rows
    texts = pc.fill_null(batch.column("text").cast(pa.string()), "")
    parts = pc.split_pattern(texts, "\n")
    sizes = pc.list_value_length(parts).cast(pa.int64())
    ends = pc.cumulative_sum(sizes)
    flat, parent = pc.list_flatten(parts), pc.list_parent_indices(parts)
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), pc.take(pc.subtract(ends, sizes), parent))

    # every part but the last of its text had a line feed; what follows the last feed is no line if it is empty
    last = pc.equal(ordinal, pc.subtract(pc.take(sizes, parent), 1))
    lines = pc.binary_join_element_wise(flat, pc.if_else(last, "", "\n"), "")
    no_line = pc.equal(pc.binary_length(pc.take(flat, pc.subtract(ends, 1))), 0)
    n = pc.subtract(sizes, no_line.cast(pa.int64()))

    places = pc.add(n, 1)
    cuts = [_remainder(batch.column(h), places) for h in ("h1", "h2")]
    first = pc.take(pc.min_element_wise(*cuts), parent)
    second = pc.take(pc.max_element_wise(*cuts), parent)

    def joined(role: pa.Array) -> pa.Array:
        counts = np.bincount(parent.filter(role).to_numpy(), minlength=rows)
        offsets = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
        return pc.binary_join(pa.ListArray.from_arrays(offsets, lines.filter(role)), "")

    prefix = joined(pc.less(ordinal, first))
    middle = joined(pc.and_(pc.greater_equal(ordinal, first), pc.less(ordinal, second)))
    suffix = joined(pc.greater_equal(ordinal, second))

    plain = pc.or_(pc.equal(texts, ""), pc.greater_equal(_remainder(batch.column("h3"), 100), rate))
    for sentinel in SENTINELS:
        plain = pc.or_(plain, pc.match_substring(texts, sentinel))
    spm = pc.less(_remainder(batch.column("h4"), 100), spm_rate)
    p, s, m = SENTINELS
    psm_text = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, "")
    spm_text = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, "")
    nothing = pa.scalar(None, pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            batch.column("key"),
            n,
            pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm")),
            pc.if_else(plain, nothing, pc.utf8_length(prefix).cast(pa.int64())),
            pc.if_else(plain, nothing, pc.utf8_length(middle).cast(pa.int64())),
            pc.if_else(plain, texts, pc.if_else(spm, spm_text, psm_text)),
        ],
        names=["key", "n", "form", "prefix_chars", "middle_chars", "output"],
    )


def fill_in_middle(
    docs: DataFrame, rate: int = 100, spm_rate: int = 50, seed: int = 7, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``(key, n, form, prefix_chars, middle_chars, output)`` of every row.

    ``rate`` percent of the texts are cut, ``spm_rate`` percent of these with the suffix first.
    """
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    digest = F.sha2(named.cast("binary"), 256)
    groups = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in bounded_slices(batch, "text"):
                yield transformed(piece, rate, spm_rate)

    narrow = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"), *groups)
    return narrow.mapInArrow(run, OUT)


def restored(form: str = "form", output: str = "output") -> F.Column:
    """The text that a transformed row came from, of its form and output alone."""
    pieces = F.split(F.col(output), "|".join(SENTINELS), -1)
    return (
        F.when(F.col(form) == "psm", F.concat(pieces[1], pieces[3], pieces[2]))
        .when(F.col(form) == "spm", F.concat(pieces[2], pieces[3], pieces[1]))
        .otherwise(F.col(output))
    )
