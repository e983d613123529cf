"""License scans: ordered signature rules over the normalised words of a text.

All columns are built-in expressions on one row; nothing is shuffled. A text is normalised to its words in
lower case, one space between them. Two prefilters gate the rules: a text must hold a word stem that all
notices share, and a rule is tried only if its own keyword stands in the text. Detections are intervals
of the normalised text; one that lies inside another of at least its priority is suppressed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelpulse.llm.line_dedup import ascii_lower
from modelpulse.llm.registry import query
from modelpulse.llm.text import documents

# Phrases that always count, with their labels.
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# Licenses: label, keyword that every branch of the pattern holds, pattern of the name over normalised words.
LICENSES = [
    ("mit", "mit", "mit"),
    ("mit-0", "mit", "mit (no attribution|0)"),
    ("apache-1.1", "apache", "apache( software)?( license)?( version| ?v)? ?1 1"),
    ("apache-2.0", "apache", "apache( software)?( license)?( version| ?v)? ?2( 0)?"),
    ("gpl", "general public", "(gnu )?general public license"),
    ("gpl", "gpl", "(gnu )?gpl"),
    ("gpl-1.0", "general public", "(gnu )?general public license( version| ?v)? ?1"),
    ("gpl-2.0", "general public", "(gnu )?general public license( version| ?v)? ?2( 0)?"),
    ("gpl-3.0", "general public", "(gnu )?general public license( version| ?v)? ?3( 0)?"),
    ("gpl-1.0-short", "gpl", "(gnu )?gpl( version| ?v)? ?1( 0)?"),
    ("gpl-2.0-short", "gpl", "(gnu )?gpl( version| ?v)? ?2( 0)?"),
    ("gpl-3.0-short", "gpl", "(gnu )?gpl( version| ?v)? ?3( 0)?"),
    ("lgpl-2.0", "library general", "(gnu )?library general public license( version| ?v)? ?2( 0)?"),
    ("lgpl-2.1", "lesser general", "(gnu )?lesser general public license( version| ?v)? ?2 1"),
    ("lgpl-3.0", "lesser general", "(gnu )?lesser general public license( version| ?v)? ?3( 0)?"),
    ("lgpl", "general public", "(gnu )?(library|lesser) general public license"),
    ("lgpl", "lgpl", "(gnu )?lgpl( version| ?v)?( ?[23]( [01])?)?"),
    ("agpl-3.0", "affero", "(gnu )?affero general public license( version| ?v)?( ?3( 0)?)?"),
    ("agpl-3.0-short", "agpl", "(gnu )?agpl( version| ?v)?( ?3( 0)?)?"),
    ("gfdl", "documentation", "gnu free documentation license( version| ?v)?( ?1 [123])?"),
    ("bsd-2-clause", "bsd", "(bsd (2|two) clause|simplified bsd|(2|two) clause bsd|freebsd)"),
    ("bsd-3-clause", "bsd", "(bsd (3|three) clause|(new|modified|revised) bsd|(3|three) clause bsd)"),
    ("bsd-4-clause", "bsd", "(bsd (4|four) clause|original bsd|(4|four) clause bsd)"),
    ("0bsd", "bsd", "(0bsd|zero clause bsd|bsd zero clause)"),
    ("bsd", "bsd", "bsd"),
    ("isc", "isc", "isc"),
    ("mpl-1.1", "mozilla", "mozilla public license( version| ?v)? ?1 1"),
    ("mpl-2.0", "mozilla", "mozilla public license( version| ?v)?( ?2( 0)?)?"),
    ("mpl-short", "mpl", "mpl( version| ?v)?( ?(1 1|2 0))?"),
    ("epl-1.0", "eclipse", "eclipse public license( version| ?v)? ?1( 0)?"),
    ("epl-2.0", "eclipse", "eclipse public license( version| ?v)?( ?2( 0)?)?"),
    ("cddl-1.0", "cddl", "cddl( version| ?v)?( ?1 0)?"),
    ("cddl-long", "distribution", "common development and distribution license( version| ?v)?( ?1 [01])?"),
    ("cpl-1.0", "common public", "common public license( version| ?v)?( ?1 0)?"),
    ("epl-ibm", "ibm", "ibm public license( version| ?v)?( ?1 0)?"),
    ("artistic-1.0", "artistic", "artistic license( version| ?v)? ?1( 0)?"),
    ("artistic-2.0", "artistic", "artistic license( version| ?v)?( ?2( 0)?)?"),
    ("zlib", "zlib", "zlib( libpng)?"),
    ("libpng", "libpng", "libpng"),
    ("bsl-1.0", "boost", "boost software license( version| ?v)?( ?1 0)?"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl( version| ?v)?( ?2)?"),
    ("cc0-1.0", "cc0", "cc0( 1 0)?( universal)?"),
    ("cc-by-3.0", "creative commons attribution", "creative commons attribution( license)?( version| ?v)? ?3( 0)?"),
    ("cc-by-4.0", "creative commons attribution", "creative commons attribution( international)?( license)?( version| ?v)? ?4( 0)?"),
    ("cc-by-sa-3.0", "creative commons attribution", "creative commons attribution share ?alike( license)?( version| ?v)? ?3( 0)?"),
    ("cc-by-sa-4.0", "creative commons attribution", "creative commons attribution share ?alike( license)?( version| ?v)? ?4( 0)?"),
    ("cc-by-nc-4.0", "creative commons attribution", "creative commons attribution non ?commercial( license)?( version| ?v)?( ?4( 0)?)?"),
    ("cc-by-nd-4.0", "creative commons attribution", "creative commons attribution no ?deriv(ative)?s( license)?( version| ?v)?( ?4( 0)?)?"),
    ("cc-by", "cc by", "cc by( [1-4] 0)?"),
    ("cc-by-sa", "cc by", "cc by sa( [1-4] 0)?"),
    ("cc-by-nc", "cc by", "cc by nc( [1-4] 0)?"),
    ("cc-by-nc-sa", "cc by", "cc by nc sa( [1-4] 0)?"),
    ("cc-by-nc-nd", "cc by", "cc by nc nd( [1-4] 0)?"),
    ("python-2.0", "python", "python( software foundation)?( license)?( version| ?v)? ?2( 0)?"),
    ("psf", "psf", "psf( license)?"),
    ("ruby", "ruby", "ruby"),
    ("php-3.01", "php", "php( license)?( version| ?v)?( ?3 0[01])?"),
    ("openssl", "openssl", "openssl"),
    ("ofl-1.1", "open font", "(sil )?open font license( version| ?v)?( ?1 [01])?"),
    ("odbl-1.0", "database", "open (data commons )?database license( version| ?v)?( ?1 0)?"),
    ("ms-pl", "microsoft", "microsoft public license"),
    ("ms-rl", "microsoft", "microsoft reciprocal license"),
    ("eupl-1.2", "european", "european union public licen[cs]e( version| ?v)?( ?1 [12])?"),
    ("upl-1.0", "universal", "universal permissive license( version| ?v)?( ?1 0)?"),
    ("postgresql", "postgresql", "postgresql"),
    ("ncsa", "ncsa", "(university of illinois )?ncsa( open source)?"),
    ("vim", "vim", "vim"),
    ("curl", "curl", "curl"),
]  # fixed values

# Forms of a notice: priority, and what stands around the name.
FORMS = [
    (100, "spdx license identifier {name}( only| or later)?"),
    (90, "licen[cs]ed under( the)?( terms( and conditions)? of)?( the)? {name}( licen[cs]e)?"),
    (80, "(distributed|released|published|provided|available|covered|issued) under( the)?( terms( and conditions)? of)?( the)? {name}( licen[cs]e)?"),
    (70, "(subject to|governed by|according to|see|under)( the)?( terms of)?( the)? {name}( licen[cs]e)?"),
    (60, "licen[cs]e {name}"),
    (50, "{name} licen[cs]e"),
]

# Sentences of the license texts themselves: priority, label, keyword that every branch holds, pattern.
TEXTS = [
    (95, "mit", "hereby granted", "permission is hereby granted free of charge to any person obtaining a copy"),
    (95, "isc", "permission to use", "permission to use copy modify and or distribute this software for any purpose"),
    (95, "bsd", "redistribution", "redistribution and use in source and binary forms with or without modification"),
    (85, "bsd-3-clause", "neither the name of", "neither the name of"),
    (85, "bsd-3-clause", "endorse", "nor the names of its contributors may be used to endorse"),
    (95, "gpl", "free software", "this program is free software you can redistribute it and or modify"),
    (95, "lgpl", "free software", "this library is free software you can redistribute it and or modify"),
    (95, "zlib", "altered", "altered source versions must be plainly marked as such"),
    (95, "unlicense", "unencumbered", "free and unencumbered software released into the public domain"),
    (85, "public-domain", "public domain", "(released|placed|dedicated|is)( in| into| to)( the)? public domain"),
    (85, "mpl-2.0", "source code form", "this source code form is subject to the terms of the mozilla public license"),
    (85, "apache-2.0", "in compliance with the license", "you may not use this file except in compliance with the license"),
    (85, "epl", "eclipse", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    (80, "proprietary", "proprietary", "proprietary and confidential"),
    (80, "proprietary", "unauthorized copying", "unauthorized copying of this file"),
]

# Stems that every rule needs one of.
STEMS = ["licen", "spdx", "hereby granted", "permission to use", "redistribut", "endorse", "neither the name of", "unauthorized copying", "free software", "altered source",
         "unencumbered", "public domain", "proprietary", "confidential", " under ", "subject to", "governed by", "according to", " see "]


def rules() -> list[tuple[str, str, str, int]]:
    """Keyword, pattern, label and priority of every rule, the highest priority first."""
    made = [(key, form.format(name=name), label, priority) for label, key, name in LICENSES for priority, form in FORMS]
    made += [(key, pattern, label, priority) for priority, label, key, pattern in TEXTS]
    return sorted(made, key=lambda r: (-r[3], r[2], r[1]))


def normalised(text: Column) -> Column:
    """Words in lower case with a space before, between and after them; one space for a text without words."""
    spaced = F.regexp_replace(F.concat(F.lit(" "), ascii_lower(text), F.lit(" ")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    return spaced


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("bigint")


def _places(norm: Column, n_words: Column, phrase: str) -> Column:
    """How often the phrase stands in the words, and its first and last start."""
    pieces = F.split(norm, f"(?<= ){phrase}(?= )", -1)
    last = n_words - (_spaces(F.element_at(pieces, -1)) - 1) - len(phrase.split())
    found = F.struct(
        (F.size(pieces) - 1).cast("bigint").alias("n"),
        (_spaces(F.element_at(pieces, 1)) - 1).alias("first"),
        last.alias("last"),
    )
    return F.when(F.contains(norm, F.lit(f" {phrase} ")), found)


def _detections(norm: Column) -> Column:
    """Intervals found by the rules whose keyword the text holds."""
    table = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip((k, f"(?<= )(?:{p})(?= )", lab, pr), ("keyword", "pattern", "label", "priority"))]) for k, p, lab, pr in rules()])
    length = lambda parts: F.aggregate(parts, F.lit(0), lambda total, x: total + F.length(x))

    def found(rule: Column) -> Column:
        hits = F.regexp_extract_all(norm, rule["pattern"], F.lit(0))
        between = F.split(norm, rule["pattern"], -1)

        def interval(hit: Column, k: Column) -> Column:
            start = length(F.slice(between, 1, k + 1)) + length(F.slice(hits, 1, k))
            return F.struct(start.alias("start"), (start + F.length(hit)).alias("end"), rule["label"].alias("label"), rule["priority"].alias("priority"))

        return F.transform(hits, interval)

    tried = F.filter(table, lambda r: F.contains(norm, r["keyword"]))
    gate = F.lit(False)
    for stem in STEMS:
        gate = gate | F.contains(norm, F.lit(stem))
    return F.when(gate, F.flatten(F.transform(tried, found)))


def _unsuppressed(found: Column) -> Column:
    def beaten(d: Column, e: Column) -> Column:
        inside = (e["start"] <= d["start"]) & (e["end"] >= d["end"])
        larger = (e["end"] - e["start"]) > (d["end"] - d["start"])
        return inside & ((e["priority"] > d["priority"]) | ((e["priority"] == d["priority"]) & larger))

    return F.filter(found, lambda d: ~F.exists(found, lambda e: beaten(d, e)))


def scan_licenses(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``,
    ``labels``, ``score`` and ``detections``.

    A null text has no words, no places and empty labels. Columns of the input with these names are replaced.
    ``score`` is the highest priority of a detection that stands, in hundredths; a base phrase counts 0.5.
    """
    new = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections")
    keep = [c for c in docs.columns if c not in new]
    rows = docs.select((F.struct(*keep) if keep else F.lit(0)).alias("_doc"), normalised(F.coalesce(F.col(text_col), F.lit(""))).alias("_norm"))
    norm = F.col("_norm")
    rows = rows.withColumn("n_words", F.greatest(_spaces(norm) - 1, F.lit(0).cast("bigint")))
    rows = rows.select("*", *[_places(norm, F.col("n_words"), phrase).alias(f"_p{i}") for i, (phrase, _) in enumerate(BASE)])
    rows = rows.withColumn("detections", _detections(norm))
    rows = rows.withColumn("detections", F.coalesce(_unsuppressed(F.col("detections")), F.array().cast("array<struct<start:int,end:int,label:string,priority:int>>")))
    n = F.lit(0).cast("bigint")
    base = F.array()
    for i, (_, label) in enumerate(BASE):
        n = n + F.coalesce(F.col(f"_p{i}.n"), F.lit(0))
    base = F.array_compact(F.array(*[F.when(F.col(f"_p{i}").isNotNull(), F.lit(label)) for i, (_, label) in enumerate(BASE)]))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    best = F.coalesce(F.array_max(F.transform("detections", lambda d: d["priority"])), F.lit(0)) / 100
    return rows.select(
        *[F.col("_doc").getField(c).alias(c) for c in keep],
        "n_words",
        n.alias("n_base"),
        F.least(*[F.col(f"_p{i}.first") for i in range(len(BASE))]).alias("first_word"),
        F.greatest(*[F.col(f"_p{i}.last") for i in range(len(BASE))]).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, F.transform("detections", lambda d: d["label"]))).alias("labels"),
        F.greatest(best, F.when(n > 0, 0.5).otherwise(0.0)).alias("score"),
        "detections",
    )


@query()
def op5_license_scan(spark, sf_dir):
    found = scan_licenses(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
