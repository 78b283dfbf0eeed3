"""Fill-in-middle transformation with cuts from one repeated-capture match.

A text is a sequence of units: a run of ASCII letters or any other single code
point. One ``fullmatch`` of ``(unit)*`` by the ``regex`` library keeps every repetition of
its group, so ``match.ends(1)`` is the list of all unit ends: its length is n, and two of its
entries are the ends of prefix and middle. There is no loop over units. The repetition is possessive,
as a unit is never given back, so a text of any length needs no backtracking.

Everything else is column expressions: the hash that draws cuts and form, the
pieces, the output and its inverse. Only the two offsets and n come back from Python.

Defined cases: a null text is empty; an empty text, or one that holds a mark already, stays plain; a null id
hashes as the empty string; repeated ids draw the same numbers; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyvane.llm._tables import begin, read

UNITS = r"([A-Za-z]++|[^A-Za-z])*+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def cuts(texts: pd.Series, first: pd.Series, second: pd.Series) -> pd.DataFrame:
    """n, and the ends (code points) of prefix and middle, for the two drawn numbers of each text."""
    import regex
    unit = regex.compile(UNITS, regex.V0)
    rows = []
    for t, x, y in zip(texts, first, second):
        ends = unit.fullmatch(t).ends(1)
        n = len(ends)
        a, b = sorted((int(x) % (n + 1), int(y) % (n + 1)))
        rows.append((n, ends[a - 1] if a else 0, ends[b - 1] if b else 0))
    return pd.DataFrame(rows, columns=["n", "to_prefix", "to_middle"], dtype="int64")


def draw(seed: str, i: int) -> Column:
    """The i-th group of eight hex digits of a digest column, as an unsigned number."""
    return F.conv(F.substring(seed, 8 * i + 1, 8), 16, 10).cast("long")


def transform(docs: DataFrame, seed: int = 1, plain_from: int = 90, spm_below: int = 20,
              text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, text, n, form, prefix, middle, suffix (null if plain) and output of every row."""
    begin(docs.sparkSession)
    find = F.pandas_udf(cuts, "n long, to_prefix long, to_middle long")
    base = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    base = base.withColumn("_d", F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256))
    base = base.select("doc_id", "text", draw("_d", 2).alias("_h3"), draw("_d", 3).alias("_h4"),
                       find("text", draw("_d", 0), draw("_d", 1)).alias("_c"))
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.col("text").contains(mark)
    form = F.when((F.col("text") == "") | marked | (F.col("_h3") % 100 >= plain_from), "plain").when(
        F.col("_h4") % 100 < spm_below, "spm").otherwise("psm")
    a, b = F.col("_c.to_prefix").cast("int"), F.col("_c.to_middle").cast("int")
    cut = base.withColumn("form", form).select(
        "doc_id", "text", F.col("_c.n").alias("n"), "form",
        *[F.when(F.col("form") != "plain", piece).alias(name) for name, piece in (
            ("prefix", F.substring("text", F.lit(1), a)),
            ("middle", F.substring("text", a + 1, b - a)),
            ("suffix", F.substring("text", b + 1, F.char_length("text"))))])
    output = F.when(F.col("form") == "psm", F.concat(F.lit(PREFIX), "prefix", F.lit(SUFFIX), "suffix", F.lit(MIDDLE), "middle")) \
        .when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), "suffix", F.lit(PREFIX), "prefix", F.lit(MIDDLE), "middle")) \
        .otherwise(F.col("text"))
    return cut.withColumn("output", output)


def restore(output: Column, form: Column) -> Column:
    """The text rebuilt from output and form. The pieces hold no mark and no mark begins inside
    another, so the first place of each is its own."""
    second = F.when(form == "psm", F.lit(SUFFIX)).otherwise(F.lit(PREFIX))
    skip, end = len(PREFIX), F.char_length(output)
    i, j = F.position(second, output), F.position(F.lit(MIDDLE), output)
    one = F.substring(output, F.lit(skip + 1), i - skip - 1)
    two = F.substring(output, i + skip, j - i - skip)
    middle = F.substring(output, j + skip, end)
    return F.when(form == "psm", F.concat(one, middle, two)).when(form == "spm", F.concat(two, middle, one)).otherwise(output)


def digest(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = transform(read(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n", "form", F.char_length("prefix").cast("long").alias("prefix_chars"),
        F.char_length("middle").cast("long").alias("middle_chars"), digest(F.col("output")).alias("output_sha256"),
        digest(restore(F.col("output"), F.col("form"))).alias("restored_sha256"))


OP12_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u FROM documents),
e AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS x,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS y,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (
  SELECT *, array_to_string(u[1:least(x, y)], '') AS prefix,
         array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS middle,
         array_to_string(u[greatest(x, y) + 1:], '') AS suffix FROM e)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM p
"""
