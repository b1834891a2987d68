"""License scans by a positional index of rare template words.

The document frequency of every word of every template is counted over all
documents. Each file that holds all words of a template's key phrases looks up the
``RARE`` rarest words (highest IDF) of the template that it holds. Their places in
the file are the postings: a place less the word's offset in the template is where
the template would start, and the starts that at least two of the words imply are
the candidates. Last, every mandatory key phrase must stand in full at the place
that the start implies, give or take ``slack`` words, so a copy may be edited
between its key phrases. The number of templates is part of the configuration, so
their word statistics are a bounded table; texts never leave their task.

Phrases (slack 0) of up to ``RARE`` words, the base among them, are found at every
place, for all their words are looked up then. A longer wording is missed only
where the file's rarest words of it stand elsewhere, all but one.

A null text is empty: no words, no places, empty labels, score 0; so are texts
without words, and an empty table gives no rows. Very long texts are scanned whole.
Ties in rarity go to the word that sorts first. Repeated rows are scanned one by
one. Other columns of the table, whatever their names, take no part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from skyledger.llm.common import lower_ascii

BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


#: How many of its rarest words of a template a file looks up.
RARE = 8
#: How far, in words, edits may have moved a key phrase of a whole wording.
SLACK = 16


@dataclass(frozen=True)
class Template:
    """A licence wording; each of ``keys`` (offset, words) must stand in full, at most ``slack`` words off."""

    label: str
    words: tuple[str, ...]
    keys: tuple[tuple[int, tuple[str, ...]], ...]
    slack: int = 0
    base: bool = False

    @property
    def key_words(self) -> list[str]:
        return sorted({w for _, key in self.keys for w in key})


def template(label: str, wording: str, *keys: str, slack: int = 0, base: bool = False) -> Template:
    """A template from plain text; without ``keys`` all of it is the key."""
    words = tuple(wording.split())
    placed = []
    for key in (tuple(k.split()) for k in keys or (wording,)):
        placed.append((next(i for i in range(len(words)) if words[i:i + len(key)] == key), key))
    return Template(label, words, tuple(placed), slack, base)


#: The phrases that every scan must report, with their labels.
BASE = (
    template("gpl", "gnu general public license", base=True),
    template("apache", "apache license", base=True),
    template("cc-by", "cc by", base=True),
    template("mit", "mit license", base=True),
)

#: Further phrases by which texts name a licence, each with the part that settles the label.
PHRASES = (
    template("gpl-3.0", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    template("gpl-2.0", "this work is licensed under the gnu general public license version 2", "gnu general public license version 2"),
    template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    template("cc-by-4.0", "this work is licensed under cc by 4 0", "cc by 4 0"),
    template("cc-by-sa", "this work is licensed under cc by sa", "cc by sa"),
    template("mit-grant", "released under the mit license"),
    template("bsd", "licensed under the bsd license", "bsd license"),
    template("mpl", "subject to the terms of the mozilla public license", "mozilla public license"),
    template("all-rights-reserved", "all rights reserved"),
)

#: Wordings of public licences and notices as words, with the phrases that no copy goes without.
WORDINGS = (
    template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation"
        " files the software to deal in the software without restriction including without limitation the rights to use copy"
        " modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software"
        " is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be"
        " included in all copies or substantial portions of the software",
        "permission is hereby granted free of charge to any person obtaining a copy", "without restriction", slack=SLACK),
    template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following"
        " conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the"
        " following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and"
        " the following disclaimer in the documentation and or other materials provided with the distribution",
        "redistribution and use in source and binary forms", "must retain the above copyright notice", slack=SLACK),
    template(
        "bsd-3-clause",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"
        " derived from this software without specific prior written permission",
        "may be used to endorse or promote products derived from this software", slack=SLACK),
    template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided"
        " that the above copyright notice and this permission notice appear in all copies",
        "permission to use copy modify", "with or without fee is hereby granted", slack=SLACK),
    template(
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any"
        " damages arising from the use of this software permission is granted to anyone to use this software for any purpose"
        " including commercial applications and to alter it and redistribute it freely subject to the following restrictions the"
        " origin of this software must not be misrepresented",
        "permission is granted to anyone to use this software for any purpose", "the origin of this software must not be misrepresented",
        slack=SLACK),
    template(
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"
        " you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed"
        " to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of"
        " any kind either express or implied",
        "you may not use this file except in compliance with the license",
        "unless required by applicable law or agreed to in writing software distributed under the license", slack=SLACK),
    *(template(
        f"gpl-{version}.0",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as"
        f" published by the free software foundation either version {version} of the license or at your option any later version",
        "under the terms of the gnu general public license as published by the free software foundation",
        f"version {version} of the license", slack=SLACK) for version in (2, 3)),
    template(
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public"
        " license as published by the free software foundation either version 2 1 of the license or at your option any later version",
        "under the terms of the gnu lesser general public license as published by the free software foundation", slack=SLACK),
    template(
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed"
        " with this file you can obtain one at",
        "if a copy of the mpl was not distributed with this file", slack=SLACK),
    template(
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell"
        " or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial"
        " and by any means",
        "free and unencumbered software released into the public domain", slack=SLACK),
)

TEMPLATES = BASE + PHRASES + WORDINGS


def words_of(text: Column | str) -> Column:
    """The words of a text, A-Z in lower case; letters, digits and all beyond ASCII make words."""
    return F.array_remove(F.split(lower_ascii(text), BREAKS), "")


def _list(words) -> Column:
    return F.split(F.lit(" ".join(words)), " ")


def _none(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def word_frequencies(words: DataFrame, templates: tuple[Template, ...]) -> dict[str, int]:
    """In how many documents each template word stands; as many entries as the templates have words."""
    wanted = sorted({w for t in templates for w in t.words})
    found = words.select(F.explode(F.array_intersect("words", _list(wanted))).alias("word"))
    counts = {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return {w: counts.get(w, 0) for w in wanted}


def _rarest(t: Template, ranked: list[str]) -> Column:
    """The rarest words of the template that the file holds; none where a key phrase lacks a word."""
    whole = F.size(F.array_intersect(_list(t.key_words), "held")) == len(t.key_words)
    own = set(t.words)
    return F.when(whole, F.slice(F.array_intersect(_list(w for w in ranked if w in own), "held"), 1, RARE)).otherwise(_none("string"))


def _implied(t: Template, rare: str) -> Column:
    """Where the template would start, once per looked-up word that says so, in order."""
    offsets = F.create_map(*[
        c for w in sorted(set(t.words)) for c in (F.lit(w), F.array(*[F.lit(i) for i, x in enumerate(t.words) if x == w]))])

    def said_by(word):
        places = F.filter("postings", lambda p: p["word"] == word)
        return F.array_distinct(F.flatten(F.transform(
            places, lambda p: F.transform(F.element_at(offsets, word), lambda o: p["at"] - o))))

    return F.array_sort(F.flatten(F.transform(rare, said_by)))


def _agreed(implied: str) -> Column:
    """The starts that at least two words imply."""
    return F.array_distinct(F.filter(implied, lambda s, i: F.coalesce(F.get(implied, i - 1) == s, F.lit(False))))


def _verified(t: Template, starts: str) -> Column:
    """The starts around which all key phrases stand."""

    def stands(start):
        found = F.lit(True)
        for at, key in t.keys:
            low = F.greatest(start + (at - t.slack), F.lit(0))
            high = F.least(start + (at + t.slack), F.size("words") - len(key))
            phrase = _list(key)
            found = found & F.when(low <= high, F.exists(
                F.sequence(low, high), lambda q: F.slice("words", q + 1, len(key)) == phrase)).otherwise(False)
        return found

    return F.filter(starts, stands)


def _places(t: Template, starts: str) -> Column:
    label, base = F.lit(t.label).alias("label"), F.lit(t.base).alias("base")
    return F.transform(starts, lambda s: F.struct(label, F.greatest(s, F.lit(0)).cast("long").alias("word"), base))


def _share(t: Template, starts: str) -> Column:
    """The best share of the template's words that stand at their places."""
    wording = _list(t.words)

    def share(start):
        in_place = F.filter(wording, lambda w, i: F.coalesce(F.get("words", start + i) == w, F.lit(False)))
        return F.size(in_place) / F.lit(float(len(t.words)))

    return F.coalesce(F.array_max(F.transform(starts, share)), F.lit(0.0))


def scan_licenses(
    docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``places`` (label,
    word: where the template starts, base), ``labels`` and ``score``."""
    words = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), words_of(F.col(f"`{text}`")).alias("words"))
    frequency = word_frequencies(words, templates)
    ranked = sorted(frequency, key=lambda w: (frequency[w], w))
    each = list(enumerate(templates))
    held = words.withColumn("held", F.array_intersect(_list(ranked), "words"))
    rare = held.select("doc_id", "words", *[_rarest(t, ranked).alias(f"rare{i}") for i, t in each])
    looked = rare.withColumn("looked", F.array_distinct(F.concat(*[f"rare{i}" for i, _ in each])))
    posting = F.transform("words", lambda w, i: F.when(F.array_contains("looked", w), F.struct(w.alias("word"), i.alias("at"))))
    posted = looked.withColumn("postings", F.when(F.size("looked") > 0, F.filter(posting, lambda p: p.isNotNull()))
                               .otherwise(_none("struct<word: string, at: int>")))
    implied = posted.select("doc_id", "words", *[_implied(t, f"rare{i}").alias(f"s{i}") for i, t in each])
    agreed = implied.select("doc_id", "words", *[_agreed(f"s{i}").alias(f"s{i}") for i, _ in each])
    found = agreed.select("doc_id", "words", *[_verified(t, f"s{i}").alias(f"t{i}") for i, t in each])
    places = F.concat(*[_places(t, f"t{i}") for i, t in each])
    labels = F.array_sort(F.array_distinct(F.filter(
        F.array(*[F.when(F.size(f"t{i}") > 0, F.lit(t.label)) for i, t in each]), lambda x: x.isNotNull())))
    return found.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), places.alias("places"), labels.alias("labels"),
        F.greatest(F.lit(0.0), *[_share(t, f"t{i}") for i, t in each]).alias("score"))


def digest_columns(scanned: DataFrame) -> DataFrame:
    base = F.filter("places", lambda p: p["base"])
    at = F.transform("base", lambda p: p["word"])
    return scanned.withColumn("base", base).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("base", lambda p: p["label"]))), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score")
