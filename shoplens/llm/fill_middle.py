"""Fill-in-the-middle transformation by block rotation in place.

A text is cut into units (a run of ASCII letters, or one other code point),
and two draws of its id's digest name the units after which prefix and middle
end. In a bytearray of the text's UTF-8 the three sentinels are inserted in
front of their segments, then neighbouring segments change places by three
reversals: ``<P>prefix<M>middle<S>suffix`` becomes
``<P>prefix<S>suffix<M>middle`` (psm) or ``<S>suffix<P>prefix<M>middle`` (spm).
Restoring finds the sentinels, rotates back and takes them out; it sees only
the output and the form.

All cuts of a run of texts come from one scan of its bytes; a run holds about
``RUN_BYTES``, a longer text makes a run of its own and is never cut short.

Defined cases: null text reads as empty; a text that is empty or contains a
sentinel stays plain (as do those that the third draw leaves out) and its
prefix_chars and middle_chars are null; rows with the same doc_id get the same
draws; a null doc_id draws by the salt alone; an empty table gives no rows;
input columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.common import text_runs

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SALT = "1:"
RATE = 90         # percent of the texts that are transformed
SPM_RATE = 20     # percent of those that put the suffix first
RUN_BYTES = 2_000_000


def reverse(buf: bytearray, lo: int, hi: int) -> None:
    buf[lo:hi] = buf[lo:hi][::-1]


def exchange(buf: bytearray, lo: int, mid: int, hi: int) -> None:
    """Swap the neighbours ``buf[lo:mid]`` and ``buf[mid:hi]`` by three reversals."""
    reverse(buf, lo, mid)
    reverse(buf, mid, hi)
    reverse(buf, lo, hi)


def arrange(buf: bytearray, first: int, second: int, form: str) -> None:
    """Put the text's segments, cut at bytes ``first`` and ``second``, into the order of ``form``."""
    buf[second:second] = SUFFIX
    buf[first:first] = MIDDLE
    buf[0:0] = PREFIX
    middle = first + len(PREFIX)
    suffix = second + len(PREFIX) + len(MIDDLE)
    exchange(buf, middle if form == "psm" else 0, suffix, len(buf))


def rebuild(buf: bytearray, form: str) -> None:
    """Undo :func:`arrange`; a plain text stays as it is."""
    if form == "plain":
        return
    size = len(buf)
    # the segment that moved to the front of its neighbour goes back behind it
    moved = 0 if form == "spm" else buf.index(SUFFIX)
    other = buf.index(PREFIX if form == "spm" else MIDDLE, moved)
    exchange(buf, moved, other, size)
    suffix = moved + size - other
    middle = buf.index(MIDDLE)
    del buf[suffix:suffix + len(SUFFIX)]
    del buf[middle:middle + len(MIDDLE)]
    del buf[:len(PREFIX)]


def draws(doc_id: str = "doc_id", salt: str = SALT) -> list:
    """The first four 8-digit groups of the salted id's sha256, as longs."""
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def cuts(texts, h1, h2):
    """Unit count, byte bounds of each text, both cuts and their code points.

    ``texts`` is an Arrow large_string array without nulls; returns the bytes
    and, per text, (begin, end, n, first, second, prefix_chars, middle_chars),
    cuts as bytes from the run's start.
    """
    import numpy as np

    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    base = int(bounds[0])
    raw = memoryview(texts.buffers()[2] or b"")[base:int(bounds[-1])]
    bounds = bounds - base
    data = np.frombuffer(raw, np.uint8)
    letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    lead = (data & 0xC0) != 0x80
    # a letter goes on with the unit before it if that is a letter of the same text
    begins = lead.copy()
    begins[1:] &= ~(letter[1:] & letter[:-1])
    starts = bounds[:-1][bounds[:-1] < bounds[1:]]
    begins[starts] = True
    unit = np.flatnonzero(begins)
    at = np.searchsorted(unit, bounds)
    n = np.diff(at)
    low, high = np.minimum(h1 % (n + 1), h2 % (n + 1)), np.maximum(h1 % (n + 1), h2 % (n + 1))
    unit = np.append(unit, len(data))
    cut = [np.where(k < n, unit[np.minimum(at[:-1] + k, len(unit) - 1)], bounds[1:]) for k in (low, high)]
    code = np.flatnonzero(lead)
    chars = [np.searchsorted(code, x) for x in (bounds[:-1], *cut)]
    return raw, bounds[:-1], bounds[1:], n, *cut, chars[1] - chars[0], chars[2] - chars[1]


def transform(docs: DataFrame, rate: int = RATE, spm_rate: int = SPM_RATE, salt: str = SALT,
              restored: bool = False) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output of every row.

    With ``restored`` also the text as :func:`rebuild` makes it from output and form.
    """
    fields = [docs.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
              T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
              T.StructField("output", T.StringType())]
    schema = T.StructType(fields + ([T.StructField("restored", T.StringType())] if restored else []))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            h = [batch.column(2 + i).to_numpy() for i in range(4)]
            for lo, texts in text_runs(batch.column(1), RUN_BYTES):
                h1, h2, h3, h4 = (x[lo:lo + len(texts)] for x in h)
                raw, begin, end, n, first, second, head, body = cuts(texts, h1, h2)
                form, out, back = [], [], []
                for i in range(len(texts)):
                    buf = bytearray(raw[begin[i]:end[i]])
                    f = "plain"
                    if buf and h3[i] % 100 < rate and not any(s in buf for s in (PREFIX, SUFFIX, MIDDLE)):
                        f = "spm" if h4[i] % 100 < spm_rate else "psm"
                        arrange(buf, int(first[i] - begin[i]), int(second[i] - begin[i]), f)
                    form.append(f)
                    out.append(bytes(buf))
                    if restored:
                        rebuild(buf, f)
                        back.append(bytes(buf))
                plain = np.array([f == "plain" for f in form], bool)
                columns = [batch.column(0).slice(lo, len(texts)), pa.array(n, pa.int64()), pa.array(form),
                           pa.array(head, pa.int64(), mask=plain), pa.array(body, pa.int64(), mask=plain),
                           pa.array(out, pa.binary()).cast(pa.string())]
                if restored:
                    columns.append(pa.array(back, pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select("doc_id", "text", *draws(salt=salt)).mapInArrow(run, schema)


def restore(outputs: DataFrame) -> DataFrame:
    """doc_id and text, rebuilt from the columns output and form."""
    schema = T.StructType([outputs.schema["doc_id"], T.StructField("text", T.StringType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for lo, texts in text_runs(batch.column(1), RUN_BYTES):
                back = []
                for x, f in zip(texts.cast(pa.large_binary()), batch.column(2).slice(lo, len(texts)).to_pylist()):
                    buf = bytearray(x.as_py())
                    rebuild(buf, f)
                    back.append(bytes(buf))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(texts)),
                                                  pa.array(back, pa.binary()).cast(pa.string())], names=schema.names)

    return outputs.select("doc_id", "output", "form").mapInArrow(run, schema)


def transform_digest(docs: DataFrame) -> DataFrame:
    """Forms, segment lengths and digests of output and rebuilt text of every row."""
    return transform(docs, restored=True).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"))
