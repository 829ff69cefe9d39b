"""Fill-in-middle transformation: in-place block rotation.

A text is a row of units, runs of the letters A-Z and a-z and single other
characters. Two cuts, drawn from a hash of the document's id, part it into
prefix, middle and suffix. The text's bytes are held in one bytearray: the
sentinels are inserted at the cuts, and two neighbouring blocks change places by
three reversals (each block, then both together). Restoring finds the sentinels,
turns the same rotation back and deletes them; the text is the same to the byte.
A text that holds a sentinel, an empty one, and a share of all others stay plain.

Defined cases: a null text is an empty one. A row without id is cut by the hash
of the bare salt. Rows are independent, so repeated rows give equal results and
ties need no rule. Extra columns are ignored. Work and memory are in proportion
to a text's bytes; texts are never cut short.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.text import slices, text_bytes

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Of 100 texts so many are transformed, and of 100 of these so many put the suffix first.
RATE, SPM_RATE = 90, 20
SALT = "1:"
#: Bytes that are looked at in one step while a unit is searched.
STEP = 1 << 20


def rotate(buffer: bytearray, start: int, middle: int, end: int) -> None:
    """Exchange the blocks ``start:middle`` and ``middle:end`` by three reversals."""
    for a, b in ((start, middle), (middle, end), (start, end)):
        buffer[a:b] = buffer[a:b][::-1]


def arrange(buffer: bytearray, cut: int, other: int, form: str) -> None:
    """Sentinels go in at the two cuts, then the blocks of the form change places."""
    buffer[other:other] = SUFFIX
    buffer[cut:cut] = MIDDLE
    buffer[0:0] = PREFIX
    middle, suffix = cut + len(PREFIX), other + len(PREFIX) + len(MIDDLE)
    rotate(buffer, middle if form == PSM else 0, suffix, len(buffer))


def restore(buffer: bytearray, form: str) -> None:
    """The inverse of ``arrange``."""
    if form == PLAIN:
        return
    if form == PSM:
        rotate(buffer, buffer.index(SUFFIX), buffer.index(MIDDLE), len(buffer))
    else:
        rotate(buffer, 0, buffer.index(PREFIX), len(buffer))
    for mark in (SUFFIX, MIDDLE, PREFIX):
        at = buffer.index(mark)
        del buffer[at:at + len(mark)]


def _place(units: np.ndarray, k: int) -> int:
    """Where unit ``k`` starts, or the end if there are only so many."""
    for at in range(0, len(units), STEP):
        here = units[at:at + STEP]
        n = int(np.count_nonzero(here))
        if k < n:
            return at + int(np.flatnonzero(here)[k])
        k -= n
    return len(units)


def _unit_starts(raw: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes start a unit, and which start a character."""
    low = raw | 32
    letter = (low >= 97) & (low <= 122)
    first = (raw & 0xC0) != 0x80
    inside = np.zeros(len(raw), bool)
    inside[1:] = letter[1:] & letter[:-1]
    edges = begins[:-1]
    inside[edges[edges < len(raw)]] = False
    return first & ~inside, first


def transformed(docs: DataFrame, rate: int = RATE, spm_rate: int = SPM_RATE, salt: str = SALT) -> DataFrame:
    """doc_id, n, form, output, prefix_chars and middle_chars (null if plain) of every text."""
    drawn = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    pair = docs.select("doc_id", "text", drawn.alias("drawn"))
    kind = pair.schema["doc_id"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            raw, begins = text_bytes(part.column("text"))
            units, first = _unit_starts(raw, begins)
            rows = []
            for k, digest in enumerate(part.column("drawn").to_pylist()):
                a, b = int(begins[k]), int(begins[k + 1])
                buffer, n = bytearray(raw[a:b].tobytes()), int(np.count_nonzero(units[a:b]))
                h1, h2, h3, h4 = (int(digest[8 * j:8 * j + 8], 16) for j in range(4))
                if not buffer or h3 % 100 >= rate or any(mark in buffer for mark in (PREFIX, SUFFIX, MIDDLE)):
                    rows.append((n, PLAIN, bytes(buffer), None, None))
                    continue
                cut, other = (_place(units[a:b], u) for u in sorted((h1 % (n + 1), h2 % (n + 1))))
                chars = [int(np.count_nonzero(first[a + x:a + y])) for x, y in ((0, cut), (cut, other))]
                form = SPM if h4 % 100 < spm_rate else PSM
                arrange(buffer, cut, other, form)
                rows.append((n, form, bytes(buffer), *chars))
            n, form, output, prefix, middle = zip(*rows, strict=True)
            yield pa.record_batch([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(form), pa.array(output, pa.binary()).cast(pa.string()),
                                   pa.array(prefix, pa.int64()), pa.array(middle, pa.int64())], ["doc_id", "n", "form", "output", "prefix_chars", "middle_chars"])

    return pair.mapInArrow(of, f"doc_id {kind}, n long, form string, output string, prefix_chars long, middle_chars long")


def restored(rows: DataFrame) -> DataFrame:
    """``rows`` (output, form and any other columns) with the original text as ``restored``."""
    kept = [c for c in rows.columns if c.lower() != "restored"]
    schema = rows.select(*kept).schema.add("restored", "string")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "output"):
            texts = []
            for output, form in zip(part.column("output").to_pylist(), part.column("form").to_pylist(), strict=True):
                buffer = bytearray((output or "").encode())
                restore(buffer, form)
                texts.append(bytes(buffer))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(texts, pa.binary()).cast(pa.string())], names=schema.names)

    return rows.mapInArrow(of, schema)


def fim_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the digests of output and restored text of every document."""
    rows = restored(transformed(docs))
    digest = {f"{c}_sha256": F.sha2(F.col(c).cast("binary"), 256) for c in ("output", "restored")}
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *(v.alias(k) for k, v in digest.items()))


SQL = f"""
WITH parts AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
  sha256('{SALT}' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (SELECT *, CAST(len(units) AS BIGINT) AS n, {', '.join(f"CAST('0x' || h[{8 * k + 1}:{8 * k + 8}] AS BIGINT) AS h{k + 1}" for k in range(4))} FROM parts),
formed AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= {RATE} THEN 'plain'
       WHEN h4 % 100 < {SPM_RATE} THEN 'spm' ELSE 'psm' END AS form FROM drawn),
cut AS (SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:n], '') AS suffix FROM formed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cut
"""
