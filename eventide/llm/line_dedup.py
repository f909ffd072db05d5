"""Line deduplication by a deletion-neighbourhood join. SQL functions only.

Lines are compared in lower case without blanks at their ends; lines of fewer than
``MIN_CHARS`` characters are left alone, because one edit makes another word of a short
one and headings, brackets and list marks belong to their texts. With ``min_equal`` set,
lines that are equal go from that many characters on. Blank lines always stay. A line is
removed if an earlier line, by document id and place, is equal to it or one edit away
(one character inserted, deleted or replaced; Levenshtein distance 1). Earlier lines
count whether or not they are removed themselves.

Equal lines meet by hash and are counted before the exchange. Distinct lines
that are one edit apart are found by their deletion neighbourhoods: a line
stands for itself with one character left out, at every place, as hashed keys, and
lines with a common key are compared by edit distance. All places of all lines
would be too many keys. One edit leaves all but one block of a line as they
are, so blocks are used first to tell where a line can have a neighbour at all, with
two blocks (from hashes alone) and then with ``BLOCKS`` of them: only the block in
which a pair may differ is varied, and its keys carry the hash of the rest. This
loses no pair.

Keys are grouped, never paired. Lines of one length with a common key are one edit
apart, so the earliest of them answers for the others. Where a shorter line meets
longer ones, these may be two edits apart: longer lines are compared with the
shorter one, and the shorter one with the earliest longer one. A key with many lines
thus costs no more than its lines.

Defined cases: a null or empty text has no line to remove. Rows without an id
stay as they are, and their lines take no part. Rows with equal id and text are
treated alike: they do not remove each other's lines. Equal ids with different texts
count as different rows. Other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import saved

MIN_CHARS = 20
BLOCKS = 8
_NL = "\n"


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Id and text hash of a row, which name it, and its text."""
    return docs.select(
        F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("row"), F.col(text).alias("text")
    )


def _lines(docs: DataFrame, doc_id: str, text: str, least: int) -> DataFrame:
    """Comparable lines with their place and two hashes, which name a distinct line."""
    rows = _rows(docs, doc_id, text).where("id IS NOT NULL AND text IS NOT NULL")
    lines = rows.select("id", "row", F.posexplode(F.split("text", _NL, -1)).alias("nr", "line"))
    lines = lines.withColumn("line", F.lower(F.btrim("line", F.lit(" \t\r"))))
    lines = lines.withColumn("n", F.char_length("line")).where(F.col("n") >= least)
    return lines.withColumns(
        {"k1": F.xxhash64(F.lit(1), F.col("line")), "k2": F.xxhash64(F.lit(2), F.col("line"))}
    )


def _part(line: Column, first: Column, length: Column) -> Column:
    """``length`` characters from ``first`` (from 0) on."""
    return F.substring(line, first + 1, length)


def _half_keys(line: Column, n: Column) -> list[Column]:
    """Hashes of both halves, for pairs whose shorter line has ``n`` or ``n - 1`` characters."""
    keys = []
    for short in (n, n - 1):
        half = F.floor(short / 2).cast("int")
        keys.append(F.xxhash64(F.lit(0), short, F.substring(line, F.lit(1), half)))
        keys.append(F.xxhash64(F.lit(1), short, F.substring(line, n - (short - half) + 1, short - half)))
    return keys


def _shared(keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs more than once."""
    common = keys.groupBy(key).agg(F.count("*").alias("_times")).where("_times > 1").select(key)
    return keys.join(common, key, "left_semi")


def _near_lines(docs, firsts, doc_id, text) -> DataFrame:
    """Distinct lines (k1, k2) that have an earlier line one edit away."""
    halves = firsts.select("k1", "k2", F.explode("halves").alias("key"))
    found = _shared(halves, "key").select("k1", "k2").distinct()
    # The texts of these lines, read from the rows they first stand in.
    wanted = firsts.join(found, ["k1", "k2"], "left_semi").select("k1", "k2", "at.*", "at")
    wanted = wanted.groupBy("id", "row").agg(F.collect_list(F.struct("nr", "k1", "k2", "at")).alias("wanted"))
    texts = _rows(docs, doc_id, text).where("id IS NOT NULL AND text IS NOT NULL")
    texts = texts.join(wanted, ["id", "row"]).dropDuplicates(["id", "row"])
    texts = texts.withColumn("lines", F.split("text", _NL, -1)).select("lines", F.explode("wanted").alias("w"))
    line = F.lower(F.btrim(F.get("lines", F.col("w.nr")), F.lit(" \t\r")))
    near = saved(texts.select("w.k1", "w.k2", "w.at", line.alias("line")), "lines")

    line, n, short, b = F.col("line"), F.col("n"), F.col("short"), F.col("b")
    low = F.floor(b * short / BLOCKS).cast("int")
    high = F.floor((b + 1) * short / BLOCKS).cast("int")
    blocks = (
        near.withColumn("n", F.char_length("line"))
        .withColumn("short", F.explode(F.array(n, n - 1)))
        .withColumn("b", F.explode(F.array(*map(F.lit, range(BLOCKS)))))
        .withColumns({"low": low, "rest": short - high})
        .select(
            "k1",
            "k2",
            "at",
            (n > short).alias("longer"),
            F.xxhash64(
                short, b, F.substring(line, F.lit(1), F.col("low")), F.substring(line, n - F.col("rest") + 1, F.col("rest"))
            ).alias("key"),
            _part(line, F.col("low"), n - F.col("low") - F.col("rest")).alias("middle"),
        )
    )
    blocks = _shared(blocks, "key")
    # The neighbourhood of the block: a longer line without each of its characters meets the shorter
    # one as it is; lines of one length meet without the character at the same place.
    middle, size, at = F.col("middle"), F.char_length("middle"), F.col("out")
    # Place 0 stands for the block as it is.
    places = F.sequence(F.when(F.col("longer"), F.lit(1)).otherwise(F.lit(0)), F.greatest(size, F.lit(1)))
    left = F.when(at == 0, middle).otherwise(
        F.concat(F.substring(middle, F.lit(1), at - 1), F.substring(middle, at + 1, size))
    )
    variants = blocks.withColumn("out", F.explode(places)).select(
        "k1",
        "k2",
        "at",
        "longer",
        F.xxhash64("key", F.when(F.col("longer"), F.lit(0)).otherwise(at), left).alias("variant"),
    )
    variants = variants.distinct()
    mine = F.struct("at", "k1", "k2")
    earliest = variants.groupBy("variant").agg(
        F.min(F.when(~F.col("longer"), mine)).alias("shorter"),
        F.min(F.when(F.col("longer"), mine)).alias("long"),
        F.count("*").alias("times"),
    )
    # Longer lines that are one edit apart meet by keys of their own length.
    pairs = variants.join(earliest.where("times > 1 AND shorter IS NOT NULL"), "variant")
    partners = F.when(F.col("longer"), F.array("shorter")).otherwise(F.array("shorter", "long"))
    pairs = pairs.select("k1", "k2", "at", F.explode(partners).alias("first")).where("first.at < at")
    pairs = pairs.select("k1", "k2", F.col("first.k1").alias("e1"), F.col("first.k2").alias("e2")).distinct()
    own = near.select("k1", "k2", F.col("line").alias("mine"))
    other = near.select(F.col("k1").alias("e1"), F.col("k2").alias("e2"), F.col("line").alias("theirs"))
    pairs = pairs.join(own, ["k1", "k2"]).join(other, ["e1", "e2"])
    return pairs.where(F.levenshtein("mine", "theirs", 1) == 1).select("k1", "k2").distinct()


def repeated_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_equal: int | None = None,
) -> DataFrame:
    """Line numbers to remove as ``removed``, by ``id`` and text hash ``row``; rows without any are left out."""
    lines = _lines(docs, doc_id, text, min_chars if min_equal is None else max(1, min_equal))
    # Lines without halves are not held against others.
    named = lines.withColumn("halves", F.when(F.col("n") >= min_chars, F.array(*_half_keys(F.col("line"), F.col("n")))))
    firsts = named.groupBy("k1", "k2").agg(
        F.min(F.struct("id", "nr", "row")).alias("at"),
        F.count("*").alias("times"),
        F.first("halves").alias("halves"),
    )
    firsts = saved(firsts, "distinct")
    near = saved(_near_lines(docs, firsts, doc_id, text), "near")
    repeated = firsts.where("times > 1").select("k1", "k2", "at", F.lit(False).alias("near"))
    near = near.select("k1", "k2", F.lit(None).cast(repeated.schema["at"].dataType).alias("at"), F.lit(True).alias("near"))
    gone = repeated.unionByName(near).groupBy("k1", "k2").agg(F.max("at").alias("at"), F.max("near").alias("near"))
    gone = saved(gone, "gone")
    places = lines.select("k1", "k2", F.struct("id", "nr", "row").alias("place"))
    places = places.join(gone, ["k1", "k2"]).where("near OR place > at").select("place.*")
    return saved(places.groupBy("id", "row").agg(F.collect_set("nr").alias("removed")), "removed")


def without_lines(text: Column, removed: Column) -> Column:
    """The text without the lines of these numbers."""

    def kept(lines):
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), removed)
        return F.array_join(F.transform(left, lambda nr: F.get(lines, nr)), _NL)

    # As the variable of an outer function the lines are split once, not for each number.
    split = F.transform(F.array(F.split(text, _NL, -1)), kept)
    return F.when(removed.isNull(), text).otherwise(F.get(split, F.lit(0)))


def dedup_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    removed: str = "removed",
    min_equal: int | None = None,
) -> DataFrame:
    """``docs`` without repeated lines, and the numbers of the lines taken from each row as ``removed``."""
    columns = docs.columns
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    i, t = (f"c{columns.index(c)}" for c in (doc_id, text))
    gone = repeated_lines(docs, doc_id, text, min_chars, min_equal).select(
        F.col("id").alias("_id"), F.col("row").alias("_row"), F.col("removed").alias("_removed")
    )
    same = (F.col(i) == F.col("_id")) & (F.xxhash64(t) == F.col("_row"))
    out = plain.join(gone, same, "left").withColumn(t, without_lines(F.col(t), F.col("_removed")))
    names = [F.col(f"c{k}").alias(c) for k, c in enumerate(columns)]
    none = F.expr("CAST(array() AS array<int>)")
    return out.select(*names, F.array_sort(F.coalesce("_removed", none)).alias(removed))


def clean_documents(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` without repeated lines; rows of which nothing but blanks is left go, unless they had nothing before."""
    mark = "removed"
    while mark in docs.columns:
        mark += "_"
    out = dedup_lines(docs, min_chars=min_chars, removed=mark)
    gone = (F.size(mark) > 0) & (F.btrim("text", F.lit(" \t\r\n")) == "")
    return out.where(~F.coalesce(gone, F.lit(False))).drop(mark)
