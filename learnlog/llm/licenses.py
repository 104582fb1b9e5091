"""License scan by diagonal voting.

All rolling word k-grams of the documents are joined by their hashes to the positions of
equal k-grams in templates, known license texts and names. A hit at word p of a document and
word t of a template votes for the diagonal p - t. Votes are counted by diagonal,
neighbouring diagonals of a template, apart where words were put in or left out, are merged,
and a span is verified by the share of the template's words that it holds. Every hit has been
compared word by word in the join.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from learnlog.llm.shared import WORD_PATTERN
from learnlog.sources.tables import materialize

#: Words in a gram of a license text, and in one of a license name.
GRAM, NAME_GRAM = 5, 2
#: Words that may be put in or left out between two parts of a span.
GAP = 40
#: Share of a license text that a span must cover.
LEAST_COVER = 0.6
#: Template words up to which the positions are broadcast; above, Spark shuffles the join.
BROADCAST_WORDS = 50_000

# Names that stand for a license by themselves.
NAMES = {
    "mit": ["mit license"],
    "apache": ["apache license"],
    "gpl": ["general public license"],
}

# License texts that are in common use.
TEXTS = {
    "mit": [
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software
        without restriction, including without limitation the rights to use, copy, modify,
        merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software.""",
    ],
    "apache": [
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
        file except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the
        License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions
        and limitations under the License.""",
    ],
    "gpl": [
        """This program is free software: you can redistribute it and/or modify it under the terms
        of the GNU General Public License as published by the Free Software Foundation, either
        version 3 of the License, or (at your option) any later version.""",
        """This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
        PURPOSE. See the GNU General Public License for more details.""",
    ],
    "bsd": [
        """Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met: Redistributions of source code
        must retain the above copyright notice, this list of conditions and the following
        disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution.""",
    ],
    "isc": [
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this
        permission notice appear in all copies.""",
    ],
    "cc": [
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY-SA 4.0.",
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "mpl": [
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a
        copy of the MPL was not distributed with this file, You can obtain one at
        http://mozilla.org/MPL/2.0/.""",
    ],
}

_DIVIDERS = WORD_PATTERN.replace("[^", "[")


def _words(text: str) -> str:
    """SQL for the words of a text. Lower-casing beyond A-Z changes no word's borders."""
    pattern = _DIVIDERS.replace("\\", "\\\\")
    return f"array_remove(split(lower(coalesce({text}, '')), '{pattern}'), '')"


def templates(spark: SparkSession, names: dict, texts: dict) -> DataFrame:
    """``template``, ``label``, ``named`` and ``text``, one row per name or license text."""
    rows = [(label, True, t) for label, own in names.items() for t in own]
    rows += [(label, False, t) for label, own in texts.items() for t in own]
    numbered = [(i, *row) for i, row in enumerate(rows)]
    return spark.createDataFrame(
        numbered, "template int, label string, named boolean, text string"
    )


def _grams(rows: DataFrame, keep: list[str], size: int) -> DataFrame:
    """One row per word position: ``pos`` and ``gram``, the word and the next size - 1 ones.

    One more row per text has no gram, and -1 - n for its n words as ``pos``.
    """
    worded = rows.select(*keep, F.expr(_words("text")).alias("words"))
    return worded.select(
        *keep,
        F.expr(
            f"""inline(concat(
              array(struct(-1 - size(words) as pos, cast(null as string) as gram)),
              transform(words, (w, i) ->
                struct(i as pos, concat_ws(' ', slice(words, i + 1, {size})) as gram))))"""
        ),
    )


def scan(docs: DataFrame, names: dict = NAMES, texts: dict = TEXTS) -> DataFrame:
    """Spans of licenses in every whole text, and the length of every text.

    One row per span: ``doc_id``, ``label``, ``named`` (a name, not a license text), ``start``
    and ``end`` in words, and ``cover``, the share of the template that is there; and
    for every distinct document one row with ``n_words`` and ``times``, the number of its rows.
    ``digest`` tells documents with one id and different texts apart. NULL and empty texts
    have no words; NULL ids are kept; other columns are not read. An empty table gives none.
    """
    spark = docs.sparkSession
    known = templates(spark, names, texts)
    words = known.select(F.sum(F.size(F.expr(_words("text"))))).first()[0] or 0
    hint = F.broadcast if words <= BROADCAST_WORDS else (lambda rows: rows)

    def positions(named: bool, size: int) -> DataFrame:
        rows = _grams(known.where(F.col("named") == named), ["template", "label", "named"], size)
        rows = rows.where((F.col("pos") >= 0) & (F.size(F.split("gram", " ")) == size))
        size_of = known.select("template", F.size(F.expr(_words("text"))).alias("length"))
        rows = rows.join(size_of, "template")
        row = F.struct("template", "label", "named", "length", F.col("pos").alias("place"))
        return rows.groupBy(F.col("gram").alias(f"gram_{size}")).agg(
            F.collect_list(row).alias(f"at_{size}")
        )

    keyed = docs.select(
        "doc_id", F.xxhash64("text", F.char_length("text")).alias("digest"), "text"
    )
    grams = _grams(keyed, ["doc_id", "digest"], GRAM)
    for named, size in ((False, GRAM), (True, NAME_GRAM)):
        place = positions(named, size)
        place = place.withColumn(f"hash_{size}", F.xxhash64(f"gram_{size}"))
        own = F.col("gram") if size == GRAM else F.substring_index("gram", " ", size)
        same = (F.xxhash64(own) == place[f"hash_{size}"]) & (own == place[f"gram_{size}"])
        grams = grams.join(hint(place), same, "left")
    at_text, at_name = F.col(f"at_{GRAM}"), F.col(f"at_{NAME_GRAM}")
    found = grams.where((F.col("pos") < 0) | at_text.isNotNull() | at_name.isNotNull())
    found = materialize(
        found.select("doc_id", "digest", "pos", at_text.alias("texts"), at_name.alias("names")),
        "license-hits",
    )
    lengths = (
        found.where("pos < 0")
        .groupBy("doc_id", "digest")
        .agg((-1 - F.min("pos")).alias("n_words"), F.count("*").alias("times"))
    )
    every = F.concat(
        F.coalesce("texts", F.expr("slice(names, 1, 0)")),
        F.coalesce("names", F.expr("slice(texts, 1, 0)")),
    )
    hits = found.where("pos >= 0").select("doc_id", "digest", "pos", F.inline(every))
    spans = _merged(_diagonals(hits))
    columns = ["doc_id", "digest"]
    return lengths.select(
        *columns, "n_words", "times",
        *[F.lit(None).cast(kind).alias(name) for name, kind in _SPAN.items()],
    ).unionByName(
        spans.select(
            *columns, F.lit(None).cast("int").alias("n_words"),
            F.lit(None).cast("bigint").alias("times"), *_SPAN,
        )
    )


_SPAN = {
    "label": "string", "named": "boolean", "start": "int", "end": "int", "cover": "double",
}


_KEYS = ["doc_id", "digest", "template", "label", "named", "length"]


def _diagonals(hits: DataFrame) -> DataFrame:
    """Votes by document, template and diagonal: the template's words that are there, the
    first of them, and from where to where they stand in the document."""
    size = F.when(F.col("named"), NAME_GRAM).otherwise(GRAM)
    votes = hits.groupBy(*_KEYS, (F.col("pos") - F.col("place")).alias("diagonal")).agg(
        # At most as many places as the template has words.
        F.collect_set("place").alias("places")
    )
    covered = F.flatten(F.transform("places", lambda p: F.sequence(p, p + size - 1)))
    first, last = F.array_min("places"), F.array_max("places")
    return votes.select(
        *_KEYS,
        "diagonal",
        F.array_distinct(covered).alias("covered"),
        first.alias("first"),
        (F.col("diagonal") + first).alias("start"),
        (F.col("diagonal") + last + size).alias("end"),
    )


def _merged(diagonals: DataFrame) -> DataFrame:
    """Verified spans: whole names, and merged neighbouring diagonals of license texts.

    A diagonal joins the one before it in the document if it lies at most ``GAP`` words
    after what is joined so far, is shifted by at most ``GAP`` words, and begins later in the
    template too; so a passage that is repeated begins a span of its own. Where a template
    repeats itself, its words also vote for other places: a diagonal whose words in the
    document all belong to the one around it is left out. The cover of a span is the share of
    the template's words that any of its diagonals holds, each word once.
    """
    names = diagonals.where("named and size(covered) = length").withColumn("cover", F.lit(1.0))
    texts = diagonals.where("not named")
    order = Window.partitionBy(*_KEYS).orderBy("start", F.desc("end"), "diagonal")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    texts = texts.withColumn("at", F.expr("transform(covered, w -> w + diagonal)"))
    texts = texts.withColumn("around", F.max(F.struct("end", "at")).over(earlier)).where(
        "around is null or end > around.end or size(array_except(at, around.at)) > 0"
    )
    apart = (
        F.lag("diagonal").over(order).isNull()
        | (F.abs(F.col("diagonal") - F.lag("diagonal").over(order)) > GAP)
        | (F.col("first") <= F.lag("first").over(order))
        | (F.col("start") > F.max("end").over(earlier) + GAP)
    )
    parts = texts.withColumn("apart", apart.cast("int"))
    parts = parts.withColumn("part", F.sum("apart").over(order))
    # A span has fewer diagonals than its template has words: their firsts ascend.
    texts = parts.groupBy(*_KEYS, "part").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("covered")))).alias("words"),
        F.min("start").alias("start"),
        F.max("end").alias("end"),
    )
    texts = texts.withColumn("cover", F.col("words") / F.col("length"))
    columns = ["doc_id", "digest", *_SPAN]
    return names.select(*columns).unionByName(
        texts.where(F.col("cover") >= LEAST_COVER).select(*columns)
    )


def summary(docs: DataFrame, names: dict = NAMES, texts: dict = TEXTS) -> DataFrame:
    """One row per row of ``docs``: its words, its license names and all its licenses.

    ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` are of the names;
    ``labels`` of names and texts; ``score`` is the best cover of any.
    """

    def joined(condition: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(condition, F.col("label")))), ",")

    base = F.col("named")
    found = scan(docs, names, texts).groupBy("doc_id", "digest").agg(
        F.max("n_words").cast("bigint").alias("n_words"),
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("bigint").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("bigint").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.lit(True)).alias("labels"),
        F.coalesce(F.max("cover"), F.lit(0.0)).alias("score"),
        F.max("times").alias("times"),
    )
    repeated = found.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return repeated.drop("digest", "times", "time")
