"""Licence scan by sparse TF-IDF cosine, and inheritance from the nearest licensed directory; DataFrame operations only.

1. Every text is cut into lines, paragraphs and sentences of paragraphs, whose line ends are as spaces. Those that name a
   licence matter are compared, as sparse TF-IDF vectors, with notices, source headers and titles; the best above
   ``LEAST_COSINE`` counts, if it holds the template's version numbers. All paragraphs that name a licence matter are also
   compared, as one vector, with those of whole licence texts. A title counts before a whole text, that before a notice.
   Document frequencies of the templates' terms come from all texts; a term that no template has weighs as one of the rarest.
2. A file is a licence file of its directory if its name says so, or if it holds next to nothing but matched sentences
   or a whole licence text.
3. A file without a match of its own inherits from the licence file in the nearest directory above. Directories are resolved
   once each, by joins of their ancestors with the licensed directories.

* The opening of the BSD licences, by itself, is taken for BSD-3-Clause; with the conditions below it they are told apart.
* Several matches of a kind in a file: the highest cosine, then the template first in alphabetical order. Several licence files in a
  directory: the highest cosine, then the first path. Origin: ``own``, ``inherited`` or ``none``.
* Null text has no sentence. A null path is in no directory; paths are taken as they are, separated by ``/``. Repeated rows are
  files of their own; extra columns do not matter. An empty table gives an empty result.
"""

from __future__ import annotations

import pkgutil
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm.common import Scratch, flat, place, query, table

LEAST_COSINE = 0.6
LEAST_TITLE = 0.95  # titles below are notices like others
LEAST_WHOLE = 0.75  # licence texts of one family are alike, and unlike all others
FILE_SHARE = 0.9  # of the words of a licence file that has no such name, in matched sentences; also the least cosine of wrapped ones
LICENCE_NAMES = r"(?i)^(licen[cs]es?|copying|copyright|unlicense)([._-].*)?$"
SENTENCE_ENDS = r"[\r\n]+|(?<=[.;!?])[ \t]+"
PARAGRAPH_ENDS = r"[\r\n][^a-z0-9]*[\r\n]"  # of lowered texts: lines without a word, also in comments
UNWRAPPED_ENDS = r"(?<=[.!?])\s+"
WORD_ENDS = "[^a-z0-9]+"

# What a sentence must hold to be looked at.
MENTIONS = "licens licenc copyright spdx warrant redistribut permission unencumbered cc0 cc-by".split() + ["public domain", "creative commons", "cc by"]

# Sentences by which texts say that they are under a licence.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
]

# What stands at the top of source files, wrapped as it may be.
HEADERS = [
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"),
    ("LGPL-2.1", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/"),
]

# First paragraphs of licence files.
TITLES = [
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
]

# Licences whose standard texts are in ``licences``.
TEXTS = "Apache-2.0 BSD-2-Clause BSD-3-Clause CC0-1.0 GPL-2.0 GPL-3.0 ISC LGPL-2.1 LGPL-3.0 MIT MPL-2.0 Unlicense".split()
AFFERO = (
    "Notwithstanding any other provision of this License, if you modify the Program, your modified version must prominently offer all "
    "users interacting with it remotely through a computer network an opportunity to receive the Corresponding Source of your version by "
    "providing access to the Corresponding Source from a network server at no charge, through some standard or customary means."
)


def standard_text(licence: str) -> str:
    return pkgutil.get_data(__package__, f"licences/{licence}.txt").decode()


def whole_texts() -> list[tuple[str, str]]:
    """The AGPL is the GPL under another name and with a section on networks."""
    texts = [(t, standard_text(t)) for t in TEXTS]
    affero = re.sub(r"GNU\s+General\s+Public", "GNU Affero General Public", dict(texts)["GPL-3.0"], flags=re.I)
    return [("AGPL-3.0", f"{affero}\n\n{AFFERO}"), *texts]


def naming(text: str) -> str:
    """The paragraphs that name a licence matter."""
    return "\n".join(p for p in re.split(PARAGRAPH_ENDS, text.lower()) if any(m in p for m in MENTIONS))


def words(lowered: Column) -> Column:
    return F.array_remove(F.split(lowered, WORD_ENDS), "")


def mentions(lowered: Column) -> Column:
    """Whether a licence matter is named: plain searches, which run over whole texts far faster than a pattern."""
    return reduce(Column.__or__, [F.contains(lowered, F.lit(m)) for m in MENTIONS])


def template_terms(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """``template, licence, kind, share, term, tf``: as many rows as the templates have words.

    ``kind`` is title, whole or notice; ``share`` is that of the words of a whole text in the paragraphs compared.
    """
    size = lambda t: len([w for w in re.split(WORD_ENDS, t.lower()) if w])
    listed = [(licence, "notice", t, 1.0) for licence, t in [*templates, *HEADERS]] + [(licence, "title", t, 1.0) for licence, t in TITLES]
    listed += [(licence, "whole", naming(t), size(naming(t)) / size(t)) for licence, t in whole_texts()]
    columns = ("licence", "kind", "text", "share")
    rows = F.array(*[F.struct(F.lit(i).alias("template"), *[F.lit(v).alias(c) for c, v in zip(columns, row)]) for i, row in enumerate(listed)])
    rows = spark.range(1).select(F.explode(rows).alias("t"))
    terms = rows.select("t.template", "t.licence", "t.kind", "t.share", F.explode(words(F.lower("t.text"))).alias("term"))
    return terms.groupBy("template", "licence", "kind", "share", "term").agg(F.count("*").alias("tf"))


def units(lowered: Column) -> Column:
    """What is compared: lines, sentences, paragraphs, and all paragraphs together, as far as they name a licence matter."""
    paragraphs = F.filter(F.split(lowered, PARAGRAPH_ENDS), mentions)
    found = {
        "line": F.filter(F.split(lowered, SENTENCE_ENDS), mentions),
        "sentence": F.filter(F.flatten(F.transform(paragraphs, lambda p: F.split(p, UNWRAPPED_ENDS))), mentions),
        "paragraph": paragraphs,
        "whole": F.array(F.array_join(paragraphs, "\n")),
    }
    named = lambda kind: lambda text: F.struct(F.lit(kind).alias("kind"), text.alias("text"))
    return F.flatten(F.array(*[F.transform(texts, named(kind)) for kind, texts in found.items()]))


def scan(files: DataFrame, key: str, path: str, text: str, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """Per row of ``files``: key, path, ``license``, ``cosine`` of the match or of the inherited one, ``origin``, and ``licensed_by``, the path of the licence file."""
    spark = files.sparkSession
    scratch = Scratch(spark, "license-scan")
    terms = scratch.store(template_terms(spark, templates), "terms")
    vocabulary = F.array(*[F.lit(t) for t in sorted({r["term"] for r in terms.select("term").distinct().collect()})])  # fixed: the templates' words

    own = flat(files)
    value = F.col(place(files, text)).cast("string")
    rows = own.select(F.col(place(files, key)).alias("key"), F.col(place(files, path)).cast("string").alias("path"), value.alias("text"))
    rows = rows.withColumn("text", F.lower(F.coalesce("text", F.lit(""))))
    rows = rows.select(
        F.monotonically_increasing_id().alias("row_id"),
        "key",
        "path",
        F.array_intersect(F.split("text", WORD_ENDS), vocabulary).alias("known"),
        F.when(mentions(F.col("text")), F.size(words(F.col("text")))).alias("n_words"),
        F.when(mentions(F.col("text")), units(F.col("text"))).alias("units"),
    )
    rows = scratch.store(rows, "rows")
    seen = rows.select(F.explode("known").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    total = rows.count()
    idf = lambda df: F.log((F.lit(total) + 2.0) / (df + 1.0))
    rarest = idf(F.lit(0))
    weights = terms.join(seen, "term", "left").withColumn("idf", idf(F.coalesce("df", F.lit(0))))
    version = F.col("term").rlike("^[0-9]$") & (F.col("kind") != "whole")
    weights = scratch.store(weights.select("template", "licence", "kind", "share", "term", (F.col("tf") * F.col("idf")).alias("w"), "idf", version.cast("int").alias("version")), "weights")
    norms = weights.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.sum("version").alias("versions"))

    unit = ["row_id", "pos", "unit"]
    parts = rows.select("row_id", F.posexplode("units").alias("pos", "u"))
    parts = parts.select("row_id", "pos", F.col("u.kind").alias("unit"), F.explode(words(F.col("u.text"))).alias("term"))  # lowered already
    counted = parts.groupBy(*unit, "term").agg(F.count("*").alias("tf"))
    rated = counted.join(F.broadcast(weights.select("term", "idf").distinct()), "term", "left")
    rated = scratch.store(rated.withColumn("v", F.col("tf") * F.coalesce("idf", rarest)), "rated")
    lengths = rated.groupBy(*unit).agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("length"), F.sum("tf").alias("words"))
    dots = rated.join(F.broadcast(weights.drop("idf")), "term").where((F.col("unit") == "whole") == (F.col("kind") == "whole"))
    dots = dots.groupBy(*unit, "template", "licence", "kind", "share").agg(F.sum(F.col("v") * F.col("w")).alias("dot"), F.sum("version").alias("held"))
    dots = dots.join(F.broadcast(norms), "template").where("held = versions").join(lengths, unit)
    cosine = F.col("dot") / (F.col("norm") * F.col("length"))
    least = F.when(F.col("kind") == "whole", LEAST_WHOLE).otherwise(LEAST_COSINE)
    best = dots.withColumn("cosine", F.round(cosine, 9)).where(F.col("cosine") >= least)
    rank = F.when((F.col("kind") == "title") & (F.col("cosine") >= LEAST_TITLE), 0).when(F.col("kind") == "whole", 1).otherwise(2)
    order = lambda *rest: F.struct((-F.col("cosine")).alias("c"), *rest)
    # lines are cut finely enough to count as they match; what is wrapped may hold other words, and counts if it is next to nothing else
    filling = F.when((F.col("unit") == "line") | (F.col("kind") == "whole") | (F.col("cosine") >= FILE_SHARE), F.col("words") / F.col("share")).otherwise(0.0)
    unit_best = best.groupBy(*unit).agg(F.min(F.struct(rank.alias("rank"), (-F.col("cosine")).alias("c"), "licence", filling.alias("words"))).alias("m"))
    of_kind = unit_best.groupBy("row_id", "unit").agg(F.min(F.struct("m.rank", "m.c", "m.licence")).alias("m"), F.sum("m.words").alias("words"))
    matched = of_kind.groupBy("row_id").agg(F.min("m").alias("m"), F.max("words").alias("matched_words"))
    matched = matched.select("row_id", F.col("m.licence").alias("licence"), (-F.col("m.c")).alias("cosine"), "matched_words")

    folder = F.regexp_replace(F.regexp_extract("path", r"^(.*)/[^/]*$", 1), "/+$", "")
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    found = rows.select("row_id", "key", "path", "n_words", folder.alias("folder"), name.alias("name")).join(matched, "row_id", "left")
    found = scratch.store(found, "found")
    is_licence = F.col("licence").isNotNull() & F.col("path").isNotNull()
    is_licence &= F.col("name").rlike(LICENCE_NAMES) | (F.col("matched_words") >= FILE_SHARE * F.col("n_words"))
    licensed = found.where(is_licence).groupBy("folder").agg(F.min(order("path", "licence")).alias("m"))
    licensed = scratch.store(licensed.select("folder", F.struct("m.licence", (-F.col("m.c")).alias("cosine"), "m.path").alias("given")), "licensed")

    folders = found.where("licence is null and path is not null").select("folder").distinct()
    parts = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    ancestors = folders.select("folder", F.explode(F.array_distinct(above)).alias("ancestor"))
    nearest = ancestors.join(licensed.withColumnRenamed("folder", "ancestor"), "ancestor")
    nearest = nearest.groupBy("folder").agg(F.max_by("given", F.length("ancestor")).alias("given"))
    nearest = scratch.store(nearest, "nearest")  # of known size, so that files are not dealt by folder if it is small
    joined = found.join(nearest, "folder", "left")
    mine = F.col("licence").isNotNull()
    given = lambda f: F.when(F.col("path").isNotNull(), F.col(f"given.{f}"))
    return joined.select(
        F.col("key").alias(key),
        F.col("path").alias(path),
        F.when(mine, F.col("licence")).otherwise(given("licence")).alias("license"),
        F.when(mine, F.col("cosine")).otherwise(given("cosine")).alias("cosine"),
        F.when(mine, "own").when(given("licence").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(mine, F.col("path")).otherwise(given("path")).alias("licensed_by"),
    )


@query("op4_license_scan")
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's path is its source, taken as a folder, and its id."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"), "text")
    return scan(docs, "doc_id", "path", "text")
