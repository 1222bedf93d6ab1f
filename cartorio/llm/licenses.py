"""License notices in texts (operator 1), in DataFrame functions only.

Texts are read as overlapping windows, twice as long as a class of notices and half overlapping, so a
notice lies whole in one of them. A window's MinHash bands retrieve notices; so many bands are taken that
a window which holds the wanted part of a notice shares one with the target probability. What is
retrieved is verified: the part of the notice's shingles that the window holds, exactly. Some notices
differ by a word or two (one version of a license from the next); where two that share so much are found
in one place, the one held in larger part is meant, and the other isn't reported.

Windows without a shingle of any notice share no band with one and are not looked at; telling so is one
pass over the shingles of a text. The notices are a fixed list, of bounded size, and travel to the text.

Defined results: a null or empty text, or one of fewer words than a shingle, holds no notice; rows of
one key are one document; texts are read whole; an empty table gives an empty table. Only the key and
the text are read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# Notices by license, as they are commonly worded.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
            "sublicense, and/or sell copies of the Software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of "
                   "the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "it under the terms of the GNU General Public License as published by the Free Software "
                "Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "it under the terms of the GNU General Public License as published by the Free Software "
                "Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
                   "implied."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-or-later"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL-3.0", "it under the terms of the GNU Lesser General Public License as published by the Free Software "
                 "Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "it under the terms of the GNU Affero General Public License as published by the Free Software "
                 "Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
            "following disclaimer."),
    ("BSD", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
            "following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                     "promote products derived from this software without specific prior written permission."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "If a copy of the MPL was not distributed with this file, You can obtain one at "
                "https://mozilla.org/MPL/2.0/."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License v. 2.0 which is available at https://www.eclipse.org/legal/epl-2.0."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
             "be held liable for any damages arising from the use of this software."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
            "fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
)

#: What separates words.
GAPS = r"[^\p{L}\p{N}]+"


@dataclass(frozen=True)
class ScanSettings:
    """``rows`` min-hashes make a band; ``collision`` is the wanted probability to share a band."""

    shingle: int = 5
    containment: float = 0.8
    rows: int = 1
    collision: float = 0.999

    @property
    def least_jaccard(self) -> float:
        """Of a window and a notice that it holds: the notice has more than half the shingles of its
        class, the window twice those of the class."""
        return self.containment * 0.5 / (2 + (1 - self.containment) * 0.5)

    @property
    def bands(self) -> int:
        miss = math.log(1 - self.collision) / math.log(1 - self.least_jaccard**self.rows)
        return math.ceil(miss)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), GAPS), lambda word: word != "")


def shingles_of(words: Column, width: int) -> Column:
    """The hash of every run of ``width`` words, in order; none for shorter texts."""

    def made(words: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(words) - width)
        return F.when(F.size(words) >= width, F.transform(
            places, lambda at: F.xxhash64(*(words[at + step] for step in range(width)))
        )).otherwise(F.array().cast("array<bigint>"))

    # As the variable of a function the words are made once a text, wherever the optimizer moves this.
    return F.transform(F.array(words), made)[0]


def bands_of(shingles: Column, settings: ScanSettings) -> Column:
    """The bands of a set: hashes of ``rows`` min-hashes and the number of the band."""

    def least(number: Column) -> Column:
        return F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, number)))

    return F.transform(
        F.sequence(F.lit(0), F.lit(settings.bands - 1)),
        lambda band: F.xxhash64(band, *(least(band * settings.rows + row) for row in range(settings.rows))),
    )


def prepared(
    spark: SparkSession, notices: Sequence[tuple[str, str]], settings: ScanSettings
) -> DataFrame:
    """One row a notice: ``license``, its distinct ``shingles``, the ``stride`` of its class, ``bands``."""
    rows = F.inline(F.array(*(
        F.struct(F.lit(name).alias("license"), F.lit(text).alias("text")) for name, text in notices
    )))
    found = spark.range(1).select(rows).select("license", words_of(F.col("text")).alias("words")).select(
        "license", F.array_distinct(shingles_of(F.col("words"), settings.shingle)).alias("shingles")
    ).filter(F.size("shingles") > 0)
    stride = F.pow(F.lit(2.0), F.ceil(F.log2(F.size("shingles").cast("double")))).cast("int")
    return found.withColumn("stride", stride).withColumn("bands", bands_of(F.col("shingles"), settings))


def license_notices(
    docs: DataFrame,
    notices: Sequence[tuple[str, str]] = NOTICES,
    settings: ScanSettings = ScanSettings(),
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``key``, ``license``, ``containment`` of the best held notice of it, and ``begin_word``: where the
    first window with that containment begins; a row for each document and license found."""
    spark = docs.sparkSession
    known = prepared(spark, notices, settings)
    listed = known.select("license", "stride", "shingles").collect()  # as many rows as notices
    by_stride: dict[int, list[int]] = {}
    for row in listed:
        by_stride.setdefault(row.stride, []).extend(row.shingles)
    every = sorted({x for shingles in by_stride.values() for x in shingles})

    shingled = docs.select(F.col(key).alias("key"), words_of(F.col(text)).alias("words")).select(
        "key", shingles_of(F.col("words"), settings.shingle).alias("shingles")
    ).filter(F.exists("shingles", lambda x: x.isin(every)))

    def windows(stride: int) -> Column:
        """The windows of a class that hold a shingle of one of its notices."""
        wanted = sorted(set(by_stride[stride]))
        hits = F.filter(
            F.transform("shingles", lambda x, at: F.when(x.isin(wanted), at)), lambda at: at.isNotNull()
        )
        number = F.transform(hits, lambda at: F.floor(at / stride).cast("int"))
        both = F.array_distinct(F.flatten(F.transform(number, lambda n: F.array(n - 1, n))))
        return F.transform(
            F.filter(both, lambda n: n >= 0),
            lambda n: F.struct(
                F.lit(stride).alias("stride"), (n * stride).alias("begin"),
                F.array_distinct(F.slice("shingles", n * stride + 1, 2 * stride)).alias("held"),
            ),
        )

    if not by_stride:
        return docs.select(F.col(key), F.lit("").alias("license"), F.lit(0.0).alias("containment"),
                           F.lit(0).alias("begin_word")).filter(F.lit(False))
    looked_at = shingled.select(
        "key", F.explode(F.concat(*(windows(stride) for stride in sorted(by_stride)))).alias("window")
    ).select("key", "window.*")
    retrieved = looked_at.select(
        "key", "stride", "begin", "held", F.explode(bands_of(F.col("held"), settings)).alias("band")
    ).join(
        known.select("stride", "license", "shingles", F.explode("bands").alias("band")), ["stride", "band"]
    )
    held = F.size(F.array_intersect("shingles", "held")) / F.size("shingles")
    best = F.max(F.struct("containment", (-F.col("begin")).alias("begin"), (-F.col("stride")).alias("stride")))
    found = (
        retrieved.select("key", "license", "stride", held.alias("containment"), "begin")
        .filter(F.col("containment") >= settings.containment)
        .groupBy("key", "license").agg(best.alias("best"))
        .select(
            "key", "license", F.col("best.containment").alias("containment"),
            (-F.col("best.begin")).alias("begin"), (-F.col("best.stride")).alias("stride"),
        )
    )
    # At most one row a license each: few, whatever the document.
    together = found.groupBy("key").agg(
        F.collect_list(F.struct("license", "containment", "begin", "stride")).alias("found")
    )
    rivals = rivals_of(listed, settings)
    meant = F.filter("found", lambda one: ~F.exists("found", lambda other: _outdone(one, other, rivals)))
    return together.select("key", F.explode(meant).alias("one")).select(
        F.col("key").alias(key), "one.license", "one.containment", F.col("one.begin").alias("begin_word")
    )


def rivals_of(notices: Sequence[Row], settings: ScanSettings) -> list[str]:
    """Pairs of licenses one of whose notices is held by a notice of the other, as text."""
    pairs = set()
    for one in notices:
        for other in notices:
            if one.license != other.license:
                shared = len(set(one.shingles) & set(other.shingles))
                if shared >= settings.containment * min(len(one.shingles), len(other.shingles)):
                    pairs.add(f"{one.license}|{other.license}")
    return sorted(pairs)


def _outdone(one: Column, other: Column, rivals: Sequence[str]) -> Column:
    """Another notice that shares most of this one is held in larger part at the same place."""
    if not rivals:
        return F.lit(False)
    return (
        F.concat_ws("|", one["license"], other["license"]).isin(list(rivals))
        & (other["containment"] > one["containment"])
        & (other["begin"] < one["begin"] + 2 * one["stride"]) & (one["begin"] < other["begin"] + 2 * other["stride"])
    )
