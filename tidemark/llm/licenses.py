"""License scans by a positional index of rare words, with DataFrame functions only."""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases and labels of the base rule: fixed values.
PHRASES = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}


@dataclass(frozen=True)
class Template:
    """A licence text, and phrases without which it does not count as found."""

    label: str
    text: str
    required: tuple[str, ...]


TEMPLATES = (
    Template("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software"
             " and associated documentation files the software to deal in the software without restriction",
             ("permission is hereby granted", "without restriction")),
    Template("apache-2-0-notice", "licensed under the apache license version 2 0 the license you may not use this file"
             " except in compliance with the license", ("apache license version 2 0",)),
    Template("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of"
             " the gnu general public license as published by the free software foundation",
             ("general public license", "free software")),
    Template("bsd-notice", "redistribution and use in source and binary forms with or without modification are permitted"
             " provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("mit-statement", "released under the mit license", ("under the mit license",)),
    Template("apache-2-0-statement", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
)


def anchors(templates, rarest: int) -> dict[int, list[tuple[str, int, float]]]:
    """For each template its ``rarest`` words of highest IDF over the templates: (word, position, idf)."""
    texts = [t.text.split() for t in templates]
    df = Counter(w for words in texts for w in set(words))
    idf = {w: math.log((1 + len(texts)) / n) for w, n in df.items()}
    out = {}
    for k, words in enumerate(texts):
        chosen = sorted(set(words), key=lambda w: (-idf[w], w))[:rarest]
        out[k] = [(w, i, idf[w]) for i, w in enumerate(words) if w in chosen]
    return out


def words_of(text: Column) -> Column:
    """Words of the whole text with A-Z in lower case; null and empty texts have none."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(F.regexp_replace(low, SEPARATORS, " "), " "), lambda w: w != "")


def places(words: Column, hits: Column, phrase: str) -> Column:
    """Starts of the phrase: a hit of its first word that the other words follow."""
    parts = phrase.split()
    follows = lambda h: [F.get(words, h["i"] + F.lit(j)) == w for j, w in enumerate(parts)]

    def at(h):
        tests = follows(h)
        whole = tests[0]
        for t in tests[1:]:
            whole = whole & t
        return F.coalesce(whole, F.lit(False))

    return F.transform(F.filter(hits, at), lambda h: h["i"])


def best_alignment(hits: Column, postings: list[tuple[str, int, float]]) -> Column:
    """The largest IDF weight whose words agree on one offset (place in the file less place in the template)."""
    by_word: dict[str, list[tuple[int, float]]] = {}
    for w, i, weight in postings:
        by_word.setdefault(w, []).append((i, weight))
    def votes(word: str, place: int, weight: float) -> Column:
        held = F.filter(hits, lambda h: h["w"] == word)
        return F.transform(held, lambda h: F.struct((h["i"] - F.lit(place)).alias("o"), F.lit(weight).alias("g")))

    parts = [votes(w, i, g) for w, at in by_word.items() for i, g in at]
    offsets = F.array_sort(F.concat(*parts))
    start = F.struct(F.lit(None).cast("int").alias("o"), F.lit(0.0).alias("run"), F.lit(0.0).alias("best"))

    def step(acc, x):
        run = F.when(acc["o"].eqNullSafe(x["o"]), acc["run"] + x["g"]).otherwise(x["g"])
        return F.struct(x["o"].alias("o"), run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    return F.aggregate(offsets, start, step, lambda acc: acc["best"])


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, rarest: int = 8, least: float = 0.7) -> DataFrame:
    """``docs`` with ``n_words, places, labels_base, labels_all, score``.

    Every file's words that are anchors of a template (its highest-IDF words)
    vote with their offset; a template is found if one offset gathers ``least``
    of its anchors' weight and all its required phrases stand in the file.
    Everything happens within the row: no shuffle, no hot group. Null and empty
    texts have no words and labels, and score 0; equal rows come out equal.
    Columns of ``docs`` with these names are replaced.
    """
    index = anchors(templates, rarest)
    firsts = {p.split()[0] for p in phrases.values()} | {p.split()[0] for t in templates for p in t.required}
    lexicon = sorted(firsts | {w for posting in index.values() for w, _, _ in posting})
    out = docs.drop("n_words", "places", "labels_base", "labels_all", "score")
    out = out.withColumn("_words", words_of(F.col("text")))
    held = F.transform("_words", lambda w, i: F.when(w.isin(lexicon), F.struct(i.alias("i"), w.alias("w"))))
    out = out.withColumn("_hits", F.filter(held, lambda h: h.isNotNull()))
    words, hits = F.col("_words"), F.col("_hits")
    out = out.withColumns({f"_p{k}": places(words, hits, p) for k, p in enumerate(phrases.values())})
    base = [F.when(F.size(f"_p{k}") > 0, F.lit(label)) for k, label in enumerate(phrases)]
    shares = {}
    for k, t in enumerate(templates):
        share = best_alignment(hits, index[k]) / F.lit(sum(g for _, _, g in index[k]))
        for p in t.required:
            share = F.when(F.size(places(words, hits, p)) > 0, share).otherwise(0.0)
        shares[f"_s{k}"] = F.when(F.size(hits) > 0, share).otherwise(0.0)
    out = out.withColumns(shares)
    found = [F.when(F.col(f"_s{k}") >= least, F.lit(t.label)) for k, t in enumerate(templates)]
    score = F.greatest(*[F.when(F.col(s) >= least, F.least(F.col(s), F.lit(1.0))).otherwise(0.0) for s in shares],
                       F.when(F.coalesce(*base).isNotNull(), 1.0).otherwise(0.0))
    return out.select(
        *[F.col(f"`{c}`") for c in docs.columns if c in out.columns],
        F.size(words).cast("long").alias("n_words"),
        F.array_sort(F.concat(*[F.col(f"_p{k}") for k in range(len(phrases))])).alias("places"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*base)))).alias("labels_base"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*base, *found)))).alias("labels_all"),
        score.alias("score"))


def op2_licenses(spark, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        F.array_join("labels_base", ",").alias("base_labels"), F.array_join("labels_all", ",").alias("labels"), "score")
