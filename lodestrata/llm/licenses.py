"""Operator 8 [native]: licence scans by a positional rare-token index.

Only DataFrame functions, in one map-only pass. The index holds, for each licence
template, its highest-IDF words and their positions. A file's occurrences of such
words look up postings; each posting votes for the place where the template would
begin, so postings intersect by relative position. A short phrase must then stand
word for word; a longer template needs half of its rare words at one place, and its
mandatory key phrases.
"""

from __future__ import annotations

import json
import math
from collections import Counter, defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# --- fixed values: phrases with their labels, and sentences of public licences with key phrases
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
TEMPLATES = {
    "mit-text": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        ["permission is hereby granted", "to deal in the software without restriction"],
    ),
    "bsd-text": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
        ["redistribution and use in source and binary forms"],
    ),
    "isc-text": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
        ["for any purpose with or without fee is hereby granted"],
    ),
    "apache-2.0-header": (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0",
        ["you may not use this file except in compliance with the license"],
    ),
    "gpl-header": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
        ["under the terms of the gnu general public license"],
    ),
    "lgpl-header": (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
        ["gnu lesser general public license"],
    ),
    "mpl-2.0-header": (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
        ["subject to the terms of the mozilla public license"],
    ),
    "cc0-text": (
        "to the extent possible under law the person who associated cc0 with this work has waived all copyright and related or neighboring rights to this work",
        ["waived all copyright and related or neighboring rights"],
    ),
    "unlicense-text": (
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software",
        ["free and unencumbered software released into the public domain"],
    ),
    "cc-by-text": (
        "this work is licensed under a creative commons attribution 4 0 international license to view a copy of this license visit http creativecommons org licenses by 4 0",
        ["creative commons attribution"],
    ),
}
# --- end of fixed values
_PER_TEMPLATE, _PER_PHRASE, _COVERAGE = 10, 1, 0.5


def build_index(phrases: dict[str, str], templates: dict[str, tuple[str, list[str]]]) -> tuple[list[dict], dict[str, list[dict]]]:
    """Entries (words, label, kind), and word -> postings (entry, position) of its rarest words.

    IDF counts the entries that hold a word, phrases and templates alike.
    """
    entries = [{"words": p.split(), "label": label, "base": True, "keys": []} for p, label in phrases.items()]
    entries += [{"words": t.split(), "label": label, "base": False, "keys": keys} for label, (t, keys) in templates.items()]
    df = Counter(w for e in entries for w in set(e["words"]))
    postings: dict[str, list[dict]] = defaultdict(list)
    for i, e in enumerate(entries):
        first = {}
        for q, w in enumerate(e["words"]):
            first.setdefault(w, q)
        rare = sorted(first, key=lambda w: (-math.log(len(entries) / df[w]), -len(w), first[w]))[: _PER_PHRASE if e["base"] else _PER_TEMPLATE]
        e["n"] = len(rare)
        for w in rare:
            postings[w].append({"t": i, "q": first[w]})
    return entries, dict(postings)


def _best_run(sorted_values: Column) -> Column:
    """Length of the longest run of equal values."""
    start = F.struct(F.lit(None).cast("long").alias("v"), F.lit(0).alias("n"), F.lit(0).alias("best"))

    def step(acc: Column, v: Column) -> Column:
        n = F.when(acc["v"] == v, acc["n"] + 1).otherwise(F.lit(1))
        return F.struct(v.alias("v"), n.alias("n"), F.greatest(acc["best"], n).alias("best"))

    return F.aggregate(sorted_values, start, step, lambda acc: acc["best"])


def _is_entry(i: int) -> Callable[[Column], Column]:
    return lambda hit: hit["t"] == i


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] | None = None, templates: dict[str, tuple[str, list[str]]] | None = None) -> DataFrame:
    """One row per input row: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``score`` is 1 where a phrase stands, else the largest share of a template's
    rare words found at one place, its key phrases given, else 0. A null text
    counts as empty: zeros, null words, empty labels. Repeated rows stay repeated.
    """
    entries, postings = build_index(PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates)
    low = F.translate(F.coalesce(F.col(text_col), F.lit("")), _UPPER, _LOWER)
    rows = docs.select(F.col(id_col), F.filter(F.split(low, _GAPS), lambda w: w != "").alias("_words"))
    index = F.from_json(F.lit(json.dumps(postings)), "map<string, array<struct<t: int, q: int>>>")
    rare = F.array(*[F.lit(w) for w in sorted(postings)])
    hits = F.flatten(F.transform(
        F.filter(F.transform("_words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda s: s["w"].isin(sorted(postings))),
        lambda s: F.transform(F.element_at(index, s["w"]), lambda p: F.struct(p["t"].alias("t"), (s["i"] - p["q"]).cast("long").alias("at"))),
    ))
    none = F.array().cast("array<struct<t: int, at: bigint>>")
    rows = rows.withColumn("_hits", F.when(F.arrays_overlap("_words", rare), hits).otherwise(none))

    def stands(hit: Column) -> Column:
        """The entry's words stand at the place that a hit votes for."""
        test = F.lit(False)
        for i, e in enumerate(entries):
            if e["base"]:
                same = F.slice("_words", (F.greatest(hit["at"], F.lit(0)) + 1).cast("int"), len(e["words"])) == F.array(*map(F.lit, e["words"]))
                test = F.when(hit["t"] == i, same).otherwise(test)
        return (hit["at"] >= 0) & test

    rows = rows.withColumn("_base", F.filter("_hits", stands))
    joined = F.concat(F.lit(" "), F.array_join("_words", " "), F.lit(" "))
    rows = rows.withColumn("_joined", F.when(F.size("_hits") > 0, joined))
    found = []
    for i, e in enumerate(entries):
        if not e["base"]:
            at = F.array_sort(F.transform(F.filter("_hits", _is_entry(i)), lambda h: h["at"]))
            share = F.when(F.size("_hits") > 0, _best_run(at) / F.lit(float(e["n"]))).otherwise(0.0)
            keys = F.lit(True)
            for k in e["keys"]:
                keys = keys & F.coalesce(F.col("_joined").contains(f" {k} "), F.lit(False))
            found.append(F.struct(F.lit(e["label"]).alias("label"), F.when((share >= _COVERAGE) & keys, F.least(share, F.lit(1.0))).otherwise(0.0).alias("share")))
    rows = rows.withColumn("_found", F.filter(F.array(*found), lambda x: x["share"] > 0) if found else F.array().cast("array<struct<label: string, share: double>>"))
    label_of = F.array(*[F.lit(e["label"]) for e in entries])
    base_labels = F.array_sort(F.array_distinct(F.transform("_base", lambda h: F.element_at(label_of, h["t"] + 1))))
    rows = rows.withColumn("_labels", base_labels)
    starts = F.transform("_base", lambda h: h["at"])
    return rows.select(
        id_col,
        F.size("_words").cast("long").alias("n_words"),
        F.size("_base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join("_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("_labels", F.transform("_found", lambda x: x["label"]))), ",").alias("labels"),
        F.when(F.size("_base") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("_found", lambda x: x["share"])), F.lit(0.0))).alias("score"),
    )
