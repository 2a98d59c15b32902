"""Arrow kernel of the partition-level word count.

Depends on pyarrow only and is serialised by value with the task closures, so executors need no
copy of the package.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc

# Text tokenised at once: a batch is cut into slices of about this many bytes.
_SLICE_BYTES = 1 << 20
_EMIT_ROWS = 1 << 16


def java_tokens(text: pa.Array) -> pa.Array:
    """The tokens of all texts, Java ``split(" ")`` rules: trailing empty ones dropped, a text of
    spaces has none, an empty text one empty token, NULL none."""
    text = text.drop_null()
    stripped = pc.utf8_rtrim(text, characters=" ")
    kept = pc.or_(pc.equal(text, ""), pc.not_equal(stripped, ""))
    return pc.list_flatten(pc.split_pattern(stripped.filter(kept), " "))


def _slices(column: pa.Array):
    """Runs of rows with about ``_SLICE_BYTES`` of text; a longer text stays whole."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    lo = size = 0
    for i, n in enumerate(lengths):
        if size and size + n > _SLICE_BYTES:
            yield column.slice(lo, i - lo)
            lo, size = i, 0
        size += n
    yield column.slice(lo)


def _combined(tables: list) -> pa.Table:
    return pa.concat_tables(tables).group_by("word").aggregate([("n", "sum")]).rename_columns(
        ["word", "n"])


def word_count_kernel(hold_bytes: int):
    """Count the words of a whole task in one table: ``(word, n)`` rows.

    Every slice's tokens are coded by a dictionary and counted, and the counts are combined with
    those held.  When the combined table is larger than ``hold_bytes`` it is sent on and a new
    one begins, so a task holds about twice that besides one slice of text."""

    def run(batches):
        held, size = [], 0

        def sent(table):
            for batch in table.combine_chunks().to_batches(max_chunksize=_EMIT_ROWS):
                yield batch

        for batch in batches:
            for text in _slices(batch.column(0)) if batch.num_rows else ():
                counts = pc.value_counts(java_tokens(text))
                table = pa.table({"word": counts.field("values"), "n": counts.field("counts")})
                held.append(table)
                size += table.nbytes
                if size > hold_bytes:
                    whole = _combined(held)
                    if whole.nbytes > hold_bytes // 2:
                        yield from sent(whole)
                        held, size = [], 0
                    else:
                        held, size = [whole], whole.nbytes
        if held:
            yield from sent(_combined(held))

    return run
