"""Fill-in-the-middle by one counted regular expression a row.

A text is a row of units; ``regexp_count`` tells how many.  Two cuts, drawn by a hash of the id, give a pattern of the
row's own: ``a`` units, then ``b - a`` units, then the rest.  One match of it captures prefix, middle and suffix, and
its replacement writes them in the order of the form.  Both counted groups are possessive: the engine then repeats the
unit in a loop and never comes back to it, so that millions of units need neither stack nor retries.  Built-in functions
only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.rows import col, text_of

#: A unit of text: a run of letters A-Z, or any other character.
UNIT = "[A-Za-z]++|[^A-Za-z]"
#: Units are counted in blocks of so many.
BLOCK = 1024
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred texts, so many are transformed, and of those so many have the suffix first.
RATE, SPM_RATE = 90, 20
SEED = 1


def _draw(id_: Column, seed: int, nth: int) -> Column:
    """The nth group of eight hexadecimal digits of the hash of seed and id, as a number."""
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(said.cast("binary"), 256), 8 * nth - 7, 8), 16, 10).cast("long")


def _units(rows: DataFrame) -> DataFrame:
    """``rows`` with n, the number of units of ``t``.  ``regexp_count`` makes an array of what it counts, so it counts full
    blocks of units first, and single units only in what stands after the last full one."""
    blocks = F.regexp_count("t", F.lit(f"(?:{UNIT}){{1,{BLOCK}}}+"))
    full = rows.withColumn("full", F.greatest(blocks - 1, F.lit(0)).cast("long") * BLOCK)
    rest = F.regexp_replace("t", F.format_string(f"\\A(?:{UNIT}){{%d}}+", "full"), F.lit(""))
    rest = F.when(F.col("full") > 0, rest).otherwise(F.col("t"))
    return full.withColumn("n", F.col("full") + F.regexp_count(rest, F.lit(UNIT)))


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE,
                   spm_rate: int = SPM_RATE) -> DataFrame:
    """One row per document: id, n, form, output, prefix_chars, middle_chars.

    ``n`` is the number of units, ``form`` is plain, psm (prefix, suffix, middle) or spm (suffix, prefix, middle), and the
    lengths are in code points, null for plain texts.  Plain are the texts not drawn, empty ones (null counts as empty) and
    those that hold a marker already, so that :func:`restored` is exact.  The same id always draws the same; rows that
    repeat an id draw alike, and a null id draws as an empty one.  Texts are taken whole; extra columns are not looked at.
    """
    rows = docs.select(col(id_col).alias("id"), text_of(text_col).alias("t"))
    drawn = _units(rows).select(
        "id", "t", "n",
        *[(_draw(F.col("id"), seed, k) % (F.col("n") + 1)).alias(c) for k, c in ((1, "c1"), (2, "c2"))],
        *[(_draw(F.col("id"), seed, k) % 100).alias(c) for k, c in ((3, "d3"), (4, "d4"))],
    )
    taken = (F.col("t") == "") | (F.col("d3") >= rate)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        taken = taken | F.contains("t", F.lit(marker))
    formed = drawn.withColumn("form", F.when(taken, "plain").when(F.col("d4") < spm_rate, "spm").otherwise("psm"))
    first, second = F.least("c1", "c2"), F.greatest("c1", "c2")
    pattern = F.format_string(f"\\A((?:{UNIT}){{%d}}+)((?:{UNIT}){{%d}}+)((?s:.*))\\z", first, second - first)
    order = F.when(F.col("form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    out = formed.withColumn("output", F.when(F.col("form") == "plain", F.col("t")).otherwise(F.regexp_replace("t", pattern, order)))
    end = F.when(F.col("form") == "spm", F.instr("output", MIDDLE)).otherwise(F.instr("output", SUFFIX))
    begin = F.when(F.col("form") == "spm", F.instr("output", PREFIX)).otherwise(F.lit(1)) + len(PREFIX)
    drawn_in = F.col("form") != "plain"
    return out.select(
        "id", "n", "form", "output",
        F.when(drawn_in, end - begin).cast("long").alias("prefix_chars"),
        F.when(drawn_in, F.length("output") - F.instr("output", MIDDLE) - len(MIDDLE) + 1).cast("long").alias("middle_chars"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text that was transformed, rebuilt from output and form."""
    parts = {"psm": (PREFIX, SUFFIX, MIDDLE, "$1$3$2"), "spm": (SUFFIX, PREFIX, MIDDLE, "$2$3$1")}
    found = F.when(form == "plain", output)
    for name, (one, two, three, order) in parts.items():
        pattern = f"(?s)\\A{one}(.*){two}(.*){three}(.*)\\z"
        found = found.when(form == name, F.regexp_replace(output, pattern, order))
    return found
