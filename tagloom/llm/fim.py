"""Fill-in-the-middle arrangements of texts and their restoration, in native expressions alone.

A text is an array of units (`regexp_extract_all`), two cuts come from a hash of its id (`sha2`, `substring`, `conv`), the
arrangement joins slices of the array, and the sentinels in an output are enough to put the text together again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One code point, line ends included.
CODE_POINT = "(?s)."
#: Sentinels before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Code points of a block. Only the two blocks that the cuts fall into are opened into units, so a text of n code points needs
#: an array of n / 64 blocks and two of 64 units, not n strings: a match costs about a microsecond.
BLOCK = 64


def draws(id_: Column, seed: int = 1) -> list[Column]:
    """Four unsigned 32-bit numbers of an id: the first groups of eight digits of the hex SHA-256 of `seed:id`; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _units(block: Column, unit: str) -> Column:
    return F.regexp_extract_all(F.coalesce(block, F.lit("")), F.lit(unit), F.lit(0))


def _joined(units: Column, after: Column, many: Column | int) -> Column:
    """The text of at most `many` units behind the first `after`."""
    return F.array_join(F.slice(units, after + 1, many if isinstance(many, Column) else F.lit(many)), "")


def arrange(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, transformed: int = 90, suffix_first: int = 20, sentinels: tuple[str, str, str] = SENTINELS, unit: str = CODE_POINT) -> DataFrame:
    """(id, text, n, form, prefix_chars, middle_chars, output) of every row.

    n counts units: matches of `unit`, a Java regex whose matches, left to right, make up a text (by default code points, then
    the lengths are in code points too). With draws h1 to h4 of the id, the prefix ends after min(h1 % (n + 1), h2 % (n + 1))
    units and the middle after the larger. The form is `plain`, and the output the text, if the text is empty, holds a
    sentinel, or h3 % 100 is `transformed` or more; else `spm` (suffix, prefix, middle) if h4 % 100 is under `suffix_first`,
    else `psm` (prefix, suffix, middle).

    Odd rows: a null text is an empty one, a null id counts as an empty one; repeated rows come out alike, once each; an empty
    table gives no rows; other columns aren't read, whatever their names. A row works on its text alone, without a shuffle,
    and a long text on its blocks, so one of many megabytes needs a few copies of itself. Units other than code points are held one by one,
    and a text that they don't make up whole is plain.
    """
    if len(set(sentinels)) != 3 or any(a in b for a in sentinels for b in sentinels if a != b) or not all(sentinels):
        raise ValueError("three sentinels, none in another")
    single = unit != CODE_POINT
    size = 1 if single else BLOCK
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("__blocks", F.regexp_extract_all("text", F.lit(unit if single else f"(?s).{{1,{BLOCK}}}"), F.lit(0)))
    rows = rows.withColumn("n", (F.size("__blocks") if single else F.length("text")).cast("long"))
    h1, h2, h3, h4 = draws(F.col("id"), seed)
    one, two = h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)
    plain = (F.col("n") == 0) | (h3 % 100 >= transformed)
    for s in sentinels:
        plain = plain | F.contains("text", F.lit(s))
    if single:
        plain = plain | (F.array_join("__blocks", "") != F.col("text"))
    form = F.when(plain, "plain").when(h4 % 100 < suffix_first, "spm").otherwise("psm")
    rows = rows.withColumn("__one", F.least(one, two)).withColumn("__two", F.greatest(one, two)).withColumn("form", form)
    first, last = ((F.col(c) - F.col(c) % size) / size for c in ("__one", "__two"))
    rows = rows.withColumn("__first", first.cast("int")).withColumn("__last", last.cast("int"))
    rows = rows.withColumn("__u1", _units(F.get("__blocks", F.col("__first")), unit)).withColumn("__u2", _units(F.get("__blocks", F.col("__last")), unit))
    r1, r2, whole = (F.col("__one") % size).cast("int"), (F.col("__two") % size).cast("int"), F.size("__blocks")
    head = F.concat(_joined(F.col("__blocks"), F.lit(0), F.col("__first")), _joined(F.col("__u1"), F.lit(0), r1))
    across = F.concat(_joined(F.col("__u1"), r1, size), _joined(F.col("__blocks"), F.col("__first") + 1, F.greatest(F.col("__last") - F.col("__first") - 1, F.lit(0))), _joined(F.col("__u2"), F.lit(0), r2))
    middle = F.when(F.col("__first") == F.col("__last"), _joined(F.col("__u1"), r1, F.greatest(r2 - r1, F.lit(0)))).otherwise(across)
    tail = F.concat(_joined(F.col("__u2"), r2, size), _joined(F.col("__blocks"), F.col("__last") + 1, whole))
    p, s, m = (F.lit(x) for x in sentinels)
    output = F.when(F.col("form") == "plain", F.col("text")).when(F.col("form") == "psm", F.concat(p, head, s, tail, m, middle)).otherwise(F.concat(s, tail, p, head, m, middle))
    cut = F.col("form") != "plain"
    return rows.select("id", "text", "n", "form", F.when(cut, F.col("__one")).alias("prefix_chars"), F.when(cut, F.col("__two") - F.col("__one")).alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text again, from an output and its form alone: what stands behind each sentinel, in the text's order. Null forms give null."""
    p, s, m = (F.lit(x) for x in sentinels)

    def cut(x: Column, by: Column, part: int) -> Column:
        return F.split_part(x, by, F.lit(part))

    ends, middle = cut(output, m, 1), cut(output, m, 2)
    psm = F.concat(cut(cut(ends, s, 1), p, 2), middle, cut(ends, s, 2))
    spm = F.concat(cut(ends, p, 2), middle, cut(cut(ends, p, 1), s, 2))
    return F.when(form == "plain", output).when(form == "psm", psm).when(form == "spm", spm)
