"""Fill-in-the-middle transformation by bit-parallelism over big integers.

A text's bytes are translated to class masks, one bit a byte: white space, and the first bytes of code points.  A unit (white
space and the word after it; white space at the end of a text is one of its own) ends where a word's bit has no word's bit
after it, so all ends come from one shift and one conjunction.  bit_count gives their number, and the end of a given rank is
found by halving the mask: the lower half's bit_count says which half holds it.

The prefix ends after one unit, the middle after a later one, both drawn from a hash of the document's id.  A document stays
plain, or becomes prefix, suffix, middle (psm) or suffix, prefix, middle (spm) behind sentinels.

Cases: null and empty texts are plain, empty and have no unit; a text that holds a sentinel stays plain, so that every output
can be undone; a null id draws as an empty one; rows that repeat an id and a text come out alike; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decisionloom.llm.common import by_value, settled, table

by_value(__name__)

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Documents in a hundred that are transformed, and of these the ones in a hundred that begin with the suffix.
RATE, SPM = 50, 80
SEED = 42

#: Digits of a base-two number for each byte value.
SPACE = bytes(0x31 if b == 0x20 or 0x09 <= b <= 0x0D else 0x30 for b in range(256))
FIRST = bytes(0x30 if 0x80 <= b < 0xC0 else 0x31 for b in range(256))


def mask(backwards: bytes, digits: bytes) -> int:
    """Bit i says whether byte i of a text, given from its end, is of the class."""
    return int(backwards.translate(digits), 2)


def unit_ends(text: bytes) -> int:
    """Bit i is set where a unit's last byte is byte i of a text that isn't empty."""
    space = mask(text[::-1], SPACE)
    word = space ^ ((1 << len(text)) - 1)
    return word & ~(word >> 1) | 1 << (len(text) - 1)


def ranked(bits: int, rank: int) -> int:
    """Place of the set bit of this rank, the lowest being the first."""
    at, width = 0, bits.bit_length()
    while width > 1:
        half = width // 2
        low = bits & ((1 << half) - 1)
        n = low.bit_count()
        if rank <= n:
            bits, width = low, half
        else:
            bits, at, width, rank = bits >> half, at + half, width - half, rank - n
    return at


def cut(text: bytes, first: int, second: int) -> tuple[int, int, int]:
    """Units of a text, and the bytes before its middle and before its suffix."""
    ends = unit_ends(text)
    n = ends.bit_count()
    low, high = sorted((first % (n + 1), second % (n + 1)))
    return n, *(ranked(ends, k) + 1 if k else 0 for k in (low, high))


def transform(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n, form, prefix_chars, middle_chars (null if plain), output, for every whole text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    draws = [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]
    text = F.coalesce("text", F.lit(""))
    plain = (text == "") | text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE) | (draws[2] % 100 >= rate)
    form = F.when(plain, "plain").when(draws[3] % 100 < spm, "spm").otherwise("psm")
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))

    def run(batches):
        for batch in batches:
            out = []
            for first, second, form, text in zip(*(c.to_pylist() for c in batch.columns[1:4]), batch.column(4), strict=True):
                text = text.as_py()
                n, a, b = cut(text, first, second) if text else (0, 0, 0)
                if form == "plain":
                    out.append((n, None, None, text))
                    continue
                starts = mask(text[::-1], FIRST)
                before = (starts & ((1 << a) - 1)).bit_count()
                inside = (starts & ((1 << b) - 1)).bit_count() - before
                whole = p + text[:a] + s + text[b:] + m + text[a:b] if form == "psm" else s + text[b:] + p + text[:a] + m + text[a:b]
                out.append((n, before, inside, whole))
            n, before, inside, whole = zip(*out, strict=True) if out else ([], [], [], [])
            columns = [batch.column(0), pa.array(n, pa.int64()), batch.column(3), pa.array(before, pa.int64()), pa.array(inside, pa.int64()), pa.array(whole, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = docs.select("doc_id", draws[0].alias("first"), draws[1].alias("second"), form.alias("form"), text.cast("binary").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    made = rows.mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output binary")
    return made.withColumn("output", F.col("output").cast("string"))


def restored(form, output):
    """The text that an output was made from: its parts between sentinels, in their first order."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    psm, spm = F.concat(part[1], part[3], part[2]), F.concat(part[2], part[3], part[1])
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def op11_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    def digests() -> DataFrame:
        rows = transform(table(spark, sf_dir, "documents"))
        back = restored(F.col("form"), F.col("output"))
        return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(back.cast("binary"), 256).alias("restored_sha256"))

    return settled(digests)


OP11_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents),
drawn AS (
  SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS x, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS y,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 50 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM cut),
parts AS (
  SELECT doc_id, t, n, form, coalesce(array_to_string(u[1:least(x, y)], ''), '') AS p,
         coalesce(array_to_string(u[least(x, y) + 1:greatest(x, y)], ''), '') AS m, coalesce(array_to_string(u[greatest(x, y) + 1:], ''), '') AS s
  FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
