"""License scans by diagonal voting, in DataFrame functions only.

All rolling word pairs of a text are joined by hash to the places of word pairs in notice templates. A match votes
for the diagonal on which the template would start. Votes are combined per diagonal, neighbouring diagonals (words
put in or left out) are merged, and a span counts when enough of the template's pairs stand in it. Phrases that must
stand word for word are the templates whose diagonal has every pair.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartlake.llm.common import row_id

#: Phrases that are looked for word for word, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Notices that may be worded a little differently, and their labels.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
}
#: Word of a text before A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    text: str
    label: str
    exact: bool

    @property
    def pairs(self) -> list[str]:
        words = self.text.split()
        return [f"{a} {b}" for a, b in zip(words, words[1:])]


BASE = tuple(Template(t, label, True) for t, label in PHRASES.items())
TEMPLATES = BASE + tuple(Template(t, label, False) for t, label in NOTICES.items())


def places(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """``(key, pair, t, at)``: a row for each word pair of each template; a table of the parameters' size."""
    if any(not 1 <= len(t.pairs) <= 62 for t in templates):
        raise ValueError("a template has 2 to 63 words")
    rows = ", ".join(f"('{pair}', {k}, {at})" for k, t in enumerate(templates) for at, pair in enumerate(t.pairs))
    return spark.sql(f"SELECT xxhash64(pair) AS key, pair, t, at FROM VALUES {rows} AS v(pair, t, at)")


def _by_template(templates: tuple[Template, ...], value) -> Column:
    return F.element_at(F.array(*[F.lit(value(t)) for t in templates]), F.col("t") + 1)


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, shift: int = 2, share: float = 0.75) -> DataFrame:
    """``docs(doc_id, text)`` to a row for each row, over whole texts.

    ``n_words``; ``n_base``, ``first_word``, ``last_word``: places of the word-for-word templates and the smallest and
    largest word they start at (null without one); ``base_labels`` and ``labels``: distinct labels, sorted, joined by
    commas (empty without one), of those and of all templates; ``score``: the largest share of a template's pairs that
    stands on its diagonal and those within ``shift`` words (0 to 1); ``spans``: (label, first word, last word, share)
    of every find. A notice counts from ``share`` on. A null text is an empty one. Null and repeated doc_ids are
    kept; an empty table gives an empty table; other columns are ignored.
    """
    words = docs.select(row_id().alias("row"), "doc_id", F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0)).alias("w"))
    pairs = F.zip_with("w", F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    cut = words.select("row", "doc_id", F.size("w").cast("bigint").alias("n_words"), pairs.alias("pairs"))
    each = cut.select("row", "doc_id", "n_words", F.posexplode_outer("pairs").alias("pos", "found")).withColumn("key", F.xxhash64(F.lower("found")))
    met = each.join(F.broadcast(places(docs.sparkSession, templates)), "key", "left")
    met = met.withColumn("t", F.when(F.translate("found", UPPER, LOWER) == F.col("pair"), F.col("t")))
    # Besides the votes, one row of each text goes on, so that a text without any is not lost.
    votes = met.where("t is not null or pos is null or pos = 0").select("row", "doc_id", "n_words", "t", (F.col("pos") - F.col("at")).cast("bigint").alias("start"), "at")
    votes = votes.withColumn("at", F.when(F.col("t").isNotNull(), F.col("at"))).repartition("row")
    lines = votes.groupBy("row", "doc_id", "n_words", "t", "start").agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("mask"))
    size = _by_template(templates, lambda t: len(t.pairs))
    exact, label = _by_template(templates, lambda t: t.exact), _by_template(templates, lambda t: t.label)
    side = Window.partitionBy("row", "doc_id", "n_words", "t").orderBy("start")
    apart = (F.col("start") - F.lag("start").over(side) > shift).cast("int")
    merged = lines.withColumn("own", F.bit_count("mask") == size).withColumn("apart", F.coalesce(apart, F.lit(0)))
    merged = merged.withColumn("line", F.when(exact, F.col("start")).otherwise(F.sum("apart").over(side)))
    spans = merged.groupBy("row", "doc_id", "n_words", "t", "line").agg(F.bit_or("mask").alias("mask"), F.min("start").alias("first"), F.max("start").alias("last"), F.max("own").alias("own"))
    spans = spans.withColumn("share", F.coalesce(F.bit_count("mask") / size, F.lit(0.0)))
    spans = spans.withColumn("base", F.coalesce(exact & F.col("own"), F.lit(False)))
    spans = spans.withColumn("counts", F.when(exact, F.col("base")).otherwise(F.coalesce(F.col("share") >= share, F.lit(False))))
    span = F.struct(label.alias("label"), F.greatest("first", F.lit(0)).alias("first"), (F.col("last") + size).alias("last"), "share")
    listed = lambda flag: F.concat_ws(",", F.array_sort(F.collect_set(F.when(F.col(flag), label))))
    return spans.groupBy("row", "doc_id", "n_words").agg(
        F.count_if("base").cast("bigint").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("first"))).alias("last_word"),
        listed("base").alias("base_labels"),
        listed("counts").alias("labels"),
        F.max("share").alias("score"),
        F.array_sort(F.collect_list(F.when(F.col("counts"), span))).alias("spans"),
    ).drop("row")
