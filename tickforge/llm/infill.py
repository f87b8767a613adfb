"""Fill-in-the-middle: texts cut into prefix, middle and suffix at line bounds, and put in an order from which a model
learns to fill the middle. Spark SQL functions alone.

A unit is a line with its end, or what follows the last line end. Two cuts come from the sha256 of a seed and the
doc_id, so they depend on nothing else. Texts that hold a sentinel stay plain, so an arrangement can always be taken
apart at its sentinels again: parts hold none, and no sentinel can arise where a part meets one, since a sentinel
begins and ends with characters that stand nowhere else within it.

Edge cases: null texts are empty, and empty ones are plain with no units; a null doc_id counts as an empty one;
repeated rows get equal cuts; very long texts are arranged whole; extra columns stay, but for those named like the
operator's own (n, form, prefix, middle, suffix, output), which are replaced; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The sentinels.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = r"[^\n]*\n|[^\n]+"


def arrange(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """`docs` with n (units), form (plain, psm or spm), prefix, middle, suffix (null if plain) and output.

    rate: percent of the texts that are arranged; spm: percent of those with the suffix first.
    """
    if not (0 <= rate <= 100 and 0 <= spm <= 100):
        raise ValueError("rate and spm are percentages")
    own = ["n", "form", "prefix", "middle", "suffix", "output"]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    number = lambda k: F.conv(F.substring("__digest", 8 * k + 1, 8), 16, 10).cast("long")
    cut = lambda k: F.pmod(number(k), F.col("n") + 1)
    # A projection each, so that no costly value is computed again where it is used twice.
    out = docs.drop(*own).withColumns({"__text": text, "__digest": digest})
    out = out.withColumn("__units", F.regexp_extract_all("__text", F.lit(UNIT), F.lit(0)))
    out = out.withColumn("n", F.size("__units").cast("long"))
    sentinel = F.col("__text").contains(PREFIX) | F.col("__text").contains(SUFFIX) | F.col("__text").contains(MIDDLE)
    plain = (F.col("n") == 0) | sentinel | (F.pmod(number(2), F.lit(100)) >= rate)
    form = F.when(plain, "plain").when(F.pmod(number(3), F.lit(100)) < spm, "spm").otherwise("psm")
    out = out.withColumns({"form": form, "__lo": F.least(cut(0), cut(1)).cast("int"), "__hi": F.greatest(cut(0), cut(1)).cast("int")})
    part = lambda start, length: F.when(F.col("form") != "plain", F.array_join(F.slice("__units", start, length), ""))
    lo, hi = F.col("__lo"), F.col("__hi")
    out = out.withColumns({"prefix": part(F.lit(1), lo), "middle": part(lo + 1, hi - lo), "suffix": part(hi + 1, F.col("n").cast("int") - hi)})
    psm = F.concat(F.lit(PREFIX), "prefix", F.lit(SUFFIX), "suffix", F.lit(MIDDLE), "middle")
    spm_first = F.concat(F.lit(SUFFIX), "suffix", F.lit(PREFIX), "prefix", F.lit(MIDDLE), "middle")
    arranged = F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm_first).otherwise(F.col("__text"))
    return out.withColumn("output", arranged).drop("__text", "__digest", "__units", "__lo", "__hi")


def restored(output: Column, form: Column) -> Column:
    """The text that an arrangement was made of, from the arrangement and its form."""
    parts = F.split(output, "<[PSM]>", -1)
    first, second, middle = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return F.when(form == "psm", F.concat(first, middle, second)).when(form == "spm", F.concat(second, middle, first)).otherwise(output)


def checked(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, and the digests of the arrangement and of the text restored from it."""
    out = arrange(docs.select("doc_id", "text"), seed, rate, spm).drop("text")
    out = out.withColumn("__back", restored(F.col("output"), F.col("form")))
    return out.select(
        "doc_id", "n", "form", F.char_length("prefix").cast("long").alias("prefix_chars"), F.char_length("middle").cast("long").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"), F.sha2("__back", 256).alias("restored_sha256"),
    )
