"""Batch "contains" lookups without pairing every request with every name.

Names are indexed by the runs of one to six characters (:data:`SIZES`) in
their lower case.  A request text is found in a name only if the name has all
of the text's runs, so each distinct text looks through the names of its rarest
run of the greatest length it has, and each of those names is held against the
whole text.  The text is matched literally, or as a pattern with ``%`` and
``_``; then only the stretches between them have runs.  A pattern of nothing
but wildcards asks for a least length, and there are no more of those than
lengths of names.

The index holds many times the rows of the names it is made from, which the
planner's estimate does not see: its joins are asked to shuffle, so that it is
never collected to be broadcast, and the names are dealt to as many tasks as
shuffles have before the runs are made (by their few bytes, one task would make
the runs of millions).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZES = (1, 2, 3, 4, 6)


def _runs(text: Column, size: int) -> Column:
    """All stretches of ``size`` characters."""
    n = F.char_length(text) - size + 1
    return F.when(n > 0, F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.substring(text, i, F.lit(size)))).otherwise(
        F.array().cast("array<string>"))


def postings(names: DataFrame) -> DataFrame:
    """(run, id) for the distinct runs of each of ``names(name, id)``; a run
    is its hash."""
    low = F.lower("name")
    runs = F.concat(*[_runs(low, size) for size in SIZES])
    return names.select(F.explode(F.array_distinct(F.transform(
        runs, lambda r: F.xxhash64(r)))).alias("run"), "id")


def like_pattern(text: Column, wildcards: bool = True) -> Column:
    """The text as a LIKE pattern to be found anywhere.  A backslash in front
    of ``%``, ``_`` or a backslash takes their meaning away, others are
    themselves."""
    # a backslash that is not itself taken away by one in front of it
    special = r"(?<=(?<!\\)(?:\\\\){0,99})\\(?![%_\\])" if wildcards \
        else r"[%_\\]"
    return F.concat(F.lit("%"), F.regexp_replace(text, special, r"\\$0"),
                    F.lit("%"))


def text_matches(names: DataFrame, name_col: str, texts: DataFrame,
                 wildcards: bool = False) -> DataFrame:
    """(text, name) for all distinct ``texts(text)`` and the names that
    contain them, ignoring case."""
    texts = texts.select("text").filter(F.col("text").isNotNull()).distinct()
    low = F.lower("text")
    if wildcards:
        # nothing but wildcards: as many characters as there are "_"
        plain = F.col("text").rlike("^[%_]*$")
        texts = texts.withColumn("asked", F.when(
            plain, F.replace("text", F.lit("%"), F.lit("")))
            .otherwise(F.col("text")))
        parts = F.split(low, r"[%_\\]")
    else:
        plain = F.col("text") == ""
        texts = texts.withColumn("asked", F.col("text"))
        parts = F.array(low)

    def of(size: int) -> Column:
        return F.flatten(F.transform(parts, lambda p: _runs(p, size)))

    runs = F.array().cast("array<string>")
    for size in SIZES:
        runs = F.when(F.size(of(size)) > 0, of(size)).otherwise(runs)
    asked = texts.select("asked").distinct().withColumnRenamed(
        "asked", "text").select("text", F.array_distinct(F.transform(
            runs, lambda r: F.xxhash64(r))).alias("runs"),
            plain.alias("plain"))
    width = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = names.select(F.col(name_col).alias("name")).filter(
        F.col("name").isNotNull()).distinct().withColumn(
        "id", F.xxhash64("name")).repartition(width, "id")
    held_against = F.ilike(F.col("name"),
                           like_pattern(F.col("text"), wildcards))

    index = postings(names)
    held = index.groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    wanted = asked.select("text", F.explode("runs").alias("run"))
    # a run that no name has makes the text one that no name has
    rarest = wanted.join(held.hint("merge"), "run", "left").groupBy("text") \
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "run"))
             .alias("r")).filter("r.n > 0").select("text", "r.run")
    found = rarest.join(index.hint("merge"), "run").join(
        names.hint("merge"), "id").filter(held_against).select("text", "name")

    # texts without a run: by the length they ask for
    size = F.char_length(F.lower("name"))
    sizes = names.select(size.alias("size")).distinct()
    bare = asked.filter(F.size("runs") == 0).withColumn("least", F.when(
        F.col("plain"), F.char_length("text")).otherwise(0)).join(
        F.broadcast(sizes), F.col("size") >= F.col("least"))
    found = found.unionByName(bare.join(names.withColumn("size", size)
                                        .hint("merge"), "size").filter(
        F.col("plain") | held_against).select("text", "name"))
    return texts.join(found.withColumnRenamed("text", "asked").hint("merge"),
                      "asked").select("text", "name")
