"""License scan: ordered signature rules behind a keyword test, overlaps settled by priority and containment.

A text is reduced to its words (runs of digits, letters and non-ASCII characters, A-Z lower-cased) joined by
single spaces.  Every rule is a regular expression over that string with a keyword that must be present before
the expression is tried, a priority and a confidence.  Everything is column expressions over one row: no shuffle,
no join, no state.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom.llm.common import ascii_lower, once

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"                  # what stands between the words of a lower-cased text
MARK = "\x01"          # stands in no word

# Base phrases and their labels.
PHRASES = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

# License families: label, keywords (one must be there), expression for its name, words of its short identifier (or none).
FAMILIES = [
    ("mit", "mit", "mit(?:[ -]?x11)?(?: expat)?", "mit"),
    ("mit-0", "mit", "mit no attribution", "mit 0"),
    ("apache-1.0", "apache", "apache(?: software)?(?: license)?(?: version)? (?:v ?)?1 0", "apache 1 0"),
    ("apache-1.1", "apache", "apache(?: software)?(?: license)?(?: version)? (?:v ?)?1 1", "apache 1 1"),
    ("apache-2.0", "apache", "apache(?: software)?(?: license)?(?: version)? (?:v ?)?2(?: 0)?", "apache 2 0"),
    ("bsd-2-clause", "bsd", "(?:2|two) clause bsd|(?:simplified|freebsd) bsd|bsd 2(?: clause)?", "bsd 2 clause"),
    ("bsd-3-clause", "bsd", "(?:3|three) clause bsd|(?:new|modified|revised) bsd|bsd 3(?: clause)?", "bsd 3 clause"),
    ("bsd-4-clause", "bsd", "(?:4|four) clause bsd|(?:original|old) bsd|bsd 4(?: clause)?", "bsd 4 clause"),
    ("0bsd", "bsd", "(?:zero|0) clause bsd|bsd zero clause|0bsd", "0bsd"),
    ("gpl-1.0", "gpl|general public", "(?:gnu )?(?:general public license|gpl)(?: version| v)? ?(?:v)?1(?: 0)?", "gpl 1 0"),
    ("gpl-2.0", "gpl|general public", "(?:gnu )?(?:general public license|gpl)(?: version| v)? ?(?:v)?2(?: 0)?", "gpl 2 0"),
    ("gpl-3.0", "gpl|general public", "(?:gnu )?(?:general public license|gpl)(?: version| v)? ?(?:v)?3(?: 0)?", "gpl 3 0"),
    ("lgpl-2.0", "lgpl|library general", "(?:gnu )?(?:library general public license|lgpl)(?: version| v)? ?(?:v)?2(?: 0)?", "lgpl 2 0"),
    ("lgpl-2.1", "lgpl|lesser general", "(?:gnu )?(?:lesser general public license|lgpl)(?: version| v)? ?(?:v)?2 1", "lgpl 2 1"),
    ("lgpl-3.0", "lgpl|lesser general", "(?:gnu )?(?:lesser general public license|lgpl)(?: version| v)? ?(?:v)?3(?: 0)?", "lgpl 3 0"),
    ("agpl-3.0", "agpl|affero", "(?:gnu )?(?:affero general public license|agpl)(?: version| v)? ?(?:v)?3(?: 0)?", "agpl 3 0"),
    ("gfdl-1.2", "gfdl|free documentation", "(?:gnu )?(?:free documentation license|gfdl)(?: version| v)? ?1 2", "gfdl 1 2"),
    ("gfdl-1.3", "gfdl|free documentation", "(?:gnu )?(?:free documentation license|gfdl)(?: version| v)? ?1 3", "gfdl 1 3"),
    ("mpl-1.1", "mpl|mozilla", "(?:mozilla public license|mpl)(?: version| v)? ?1 1", "mpl 1 1"),
    ("mpl-2.0", "mpl|mozilla", "(?:mozilla public license|mpl)(?: version| v)? ?2(?: 0)?", "mpl 2 0"),
    ("epl-1.0", "epl|eclipse", "(?:eclipse public license|epl)(?: version| v)? ?1(?: 0)?", "epl 1 0"),
    ("epl-2.0", "epl|eclipse", "(?:eclipse public license|epl)(?: version| v)? ?2(?: 0)?", "epl 2 0"),
    ("cddl-1.0", "cddl", "cddl(?: version| v)? ?1(?: 0)?", "cddl 1 0"),
    ("cddl-1.1", "cddl", "cddl(?: version| v)? ?1 1", "cddl 1 1"),
    ("eupl-1.1", "eupl|european union", "(?:european union public licen[cs]e|eupl)(?: version| v)? ?1 1", "eupl 1 1"),
    ("eupl-1.2", "eupl|european union", "(?:european union public licen[cs]e|eupl)(?: version| v)? ?1 2", "eupl 1 2"),
    ("artistic-1.0", "artistic", "artistic license(?: version| v)? ?1(?: 0)?", "artistic 1 0"),
    ("artistic-2.0", "artistic", "artistic license(?: version| v)? ?2(?: 0)?", "artistic 2 0"),
    ("isc", "isc", "isc", "isc"),
    ("zlib", "zlib", "zlib(?: libpng)?", "zlib"),
    ("bsl-1.0", "boost", "boost software license(?: version| v)? ?1(?: 0)?", "bsl 1 0"),
    ("busl-1.1", "business", "business source license(?: version| v)? ?1 1", "busl 1 1"),
    ("sspl-1.0", "server", "server side public license(?: version| v)? ?1?(?: 0)?", "sspl 1 0"),
    ("elastic-2.0", "elastic", "elastic license(?: version| v)? ?2(?: 0)?", "elastic 2 0"),
    ("unlicense", "unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl|what the fuck", "wtfpl|do what the fuck you want to public license", "wtfpl"),
    ("python-2.0", "python", "python(?: software foundation)?(?: license)?(?: version| v)? ?2(?: 0)?", "python 2 0"),
    ("php-3.01", "php", "php license(?: version| v)? ?3 01", "php 3 01"),
    ("ruby", "ruby", "ruby(?: s)?", "ruby"),
    ("perl", "perl", "same terms as perl(?: itself)?", None),
    ("ofl-1.1", "ofl|open font", "(?:sil )?open font license(?: version| v)? ?1 1", "ofl 1 1"),
    ("odbl-1.0", "odbl|open database", "(?:open database license|odbl)(?: version| v)? ?(?:1(?: 0)?)?", "odbl 1 0"),
    ("odc-by-1.0", "odc|open data commons", "open data commons attribution(?: license)?|odc by", "odc by 1 0"),
    ("pddl-1.0", "pddl|dedication and license", "public domain dedication and license|pddl", "pddl 1 0"),
    ("cc0-1.0", "cc0|cc 0|commons zero", "cc ?0(?: 1 0)?|creative commons zero", "cc0 1 0"),
    ("openrail", "open rail|openrail", "(?:bigscience )?(?:open ?rail)(?: m)?", "openrail"),
    ("afl-3.0", "academic", "academic free license(?: version| v)? ?3(?: 0)?", "afl 3 0"),
    ("osl-3.0", "open software", "open software license(?: version| v)? ?3(?: 0)?", "osl 3 0"),
    ("ms-pl", "microsoft|ms pl", "microsoft public license|ms pl", "ms pl"),
    ("ms-rl", "microsoft|ms rl", "microsoft reciprocal license|ms rl", "ms rl"),
    ("ncsa", "illinois", "university of illinois ncsa(?: open source)?", "ncsa"),
    ("postgresql", "postgresql", "postgresql", "postgresql"),
    ("upl-1.0", "universal", "universal permissive license(?: version| v)? ?1?(?: 0)?", "upl 1 0"),
    ("vim", "vim", "vim", "vim"),
    ("x11", "x11", "x11", "x11"),
    ("ecl-2.0", "educational", "educational community license(?: version| v)? ?2(?: 0)?", "ecl 2 0"),
]
# Creative Commons variants come from parts and versions.
COMMONS = [("by", "by|attribution"), ("by-sa", "by sa|attribution share ?alike"), ("by-nd", "by nd|attribution no ?deriv(?:ative)?s?"),
           ("by-nc", "by nc|attribution non ?commercial"), ("by-nc-sa", "by nc sa|attribution non ?commercial share ?alike"),
           ("by-nc-nd", "by nc nd|attribution non ?commercial no ?deriv(?:ative)?s?")]
VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]
THE = "(?:the )?(?:terms (?:and conditions )?of )?(?:the |an? )?"
# Ways to name a license: expression around its name, priority (low wins), confidence.
FORMS = [("(?:dual )?licen[cs]ed under " + THE + "(?:{n})(?: licen[cs]e)?", 1, 0.95),
         ("(?:released|distributed|available|provided|published|shared) under " + THE + "(?:{n})(?: licen[cs]e)?", 1, 0.9),
         ("(?:governed by|subject to|under the terms of|permitted by) " + THE + "(?:{n})(?: licen[cs]e)?", 2, 0.85),
         ("(?:{n}) licen[cs]e", 3, 0.7)]
# Rules that stand for themselves: label, keyword, expression, priority, confidence.
SINGLE = [
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy", 0, 0.98),
    ("isc", "permission to use", "permission to use copy modify and or distribute this software for any purpose", 0, 0.98),
    ("bsd-3-clause", "neither the name", "neither the name of(?: [^ ]+){1,8} nor the names of its contributors", 0, 0.95),
    ("bsd", "redistribution and use", "redistribution and use in source and binary forms", 1, 0.9),
    ("gpl", "free software", "this (?:program|library|file) is free software you can redistribute it", 1, 0.9),
    ("gpl-or-later", "any later version", "(?:at your option )?any later version", 3, 0.6),
    ("public-domain", "public domain", "(?:released|placed|dedicated|is) (?:in ?to|in|to) the public domain", 1, 0.9),
    ("public-domain", "public domain", "public domain", 4, 0.5),
    ("creative-commons", "creative commons", "creative commons(?: licen[cs]e)?", 4, 0.6),
    ("proprietary", "proprietary", "proprietary and confidential", 2, 0.8),
    ("proprietary", "unauthorized|unauthorised", "unauthori[sz]ed (?:copying|reproduction|distribution)", 2, 0.8),
    ("reserved", "rights reserved", "(?:all|some|no) rights reserved", 4, 0.6),
    ("copyright", "copyright", "copyright(?: c)? (?:19|20)[0-9][0-9]", 5, 0.4),
    ("unknown-license", "licen", "licen[cs]ed under", 6, 0.3),
    ("unknown-license", "licen", "(?:see|read) (?:the )?(?:file )?licen[cs]e", 6, 0.3),
    ("unknown-license", "terms", "terms of (?:use|service)", 6, 0.2),
]
LONGEST = 24           # words a match can span at most


def rules() -> list[tuple[str, str, str, int, float]]:
    """All rules in order: (label, keyword, expression, priority, confidence)."""
    out = list(SINGLE)
    for label, keyword, name, short in FAMILIES:
        out += [(label, keyword, form.format(n=name), p, c) for form, p, c in FORMS]
        if "licen" in name:
            out.append((label, keyword, name, 3, 0.6))
        if short:
            out.append((label, "spdx", f"spdx licen[cs]e identifier {short}(?: only| or later)?", 0, 0.99))
    for part, name in COMMONS:
        for v in VERSIONS:
            label = f"cc-{part}-{v.replace(' ', '.')}"
            full = f"(?:cc|creative commons) (?:{name})(?: licen[cs]e)?(?: version| v)? ?{v}(?: (?:international|unported))?"
            out.append((label, "cc |creative commons", "(?:licen[cs]ed|released|distributed|available|published|shared) under " + THE + full, 1, 0.95))
            out.append((label, "cc |creative commons", full, 3, 0.8))
            out.append((label, "spdx", f"spdx licen[cs]e identifier cc {part.replace('-', ' ')} {v}", 0, 0.99))
    return out


def spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def places(norm: Column, pattern: Column) -> Column:
    """Where ``pattern``, made for whole words, matches in ``norm``: array of (first word, last word)."""
    marked = F.regexp_replace(norm, pattern, F.lit(MARK + "$0"))
    starts = F.filter(F.transform(F.split(F.trim(marked), " "), lambda w, i: F.when(w.startswith(MARK), i)), lambda i: i.isNotNull())
    sizes = F.transform(F.regexp_extract_all(norm, pattern, F.lit(0)), spaces)
    return F.transform(F.arrays_zip(starts.alias("s"), sizes.alias("n")), lambda x: F.struct(x["s"].alias("first"), (x["s"] + x["n"]).alias("last")))


def literal_rules(found: list) -> Column:
    """The rules as one constant array of structs."""
    def one(i, rule):
        label, keyword, pattern, priority, confidence = rule
        words = ", ".join(repr(k) for k in keyword.split("|"))
        return (f"named_struct('id', {i}, 'label', {label!r}, 'keywords', array({words}), 'priority', {priority}, "
                f"'confidence', cast({confidence} as double), 'pattern', r'(?<= )(?:{pattern})(?= )')")

    return F.expr(f"array({', '.join(one(i, r) for i, r in enumerate(found))})")


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", found: list | None = None) -> DataFrame:
    """Licenses named in every text: (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans).

    Base phrases count at every place.  A rule's match is dropped when another match covers it and has a lower
    priority number, or the same priority and more words, or the same words and an earlier rule.  ``labels`` are
    the base labels and those of the matches that stay; ``score`` is the highest confidence among them (0.6 for a
    base phrase alone, 0 for nothing); ``spans`` are the matches that stay.  Null and empty texts have no words,
    no labels and score 0; repeated rows are scanned alike; other columns are ignored.
    """
    found = rules() if found is None else found
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.array_remove(F.split(ascii_lower(t), BETWEEN), "")
    d = docs.select(F.col(key).alias("_k"), once(words).alias("_w"))
    d = d.select("_k", F.size("_w").cast("long").alias("n_words"), once(F.concat(F.lit(" "), F.array_join("_w", " "), F.lit(" "))).alias("_n"))
    base = [F.when(F.contains("_n", F.lit(f" {p} ")), places(F.col("_n"), F.lit(f"(?<= ){p}(?= )"))).otherwise(
        F.array().cast("array<struct<first:int,last:int>>")) for p, _ in PHRASES]
    keywords = sorted({k for r in found for k in r[1].split("|")})
    there = F.filter(F.expr(f"array({', '.join(map(repr, keywords))})"), lambda k: F.contains(F.col("_n"), k))
    tried = F.filter(literal_rules(found), lambda r: F.arrays_overlap(F.col("_there"), r["keywords"]) & F.regexp_like(F.col("_n"), r["pattern"]))
    hits = F.flatten(F.transform(tried, lambda r: F.transform(places(F.col("_n"), r["pattern"]), lambda m: F.struct(
        m["first"].alias("first"), (-m["last"]).alias("end"), r["priority"].alias("priority"), r["id"].alias("id"),
        r["label"].alias("label"), r["confidence"].alias("confidence")))))
    none = "array<struct<first:int,end:int,priority:int,id:int,label:string,confidence:double>>"
    d = d.select("*", once(F.when(F.length("_n") > 2, there).otherwise(F.array().cast("array<string>"))).alias("_there"))
    d = d.select("_k", "n_words", *[b.alias(f"_b{i}") for i, b in enumerate(base)],
                 once(F.when(F.size("_there") > 0, F.array_sort(hits)).otherwise(F.array().cast(none))).alias("_h"))
    reach = LONGEST * len(found)       # more matches than can start within the longest match

    def covered(x, i):
        near = F.slice("_h", F.greatest(F.lit(1), i + 1 - reach), F.lit(2 * reach))
        return F.exists(near, lambda y: (y["first"] <= x["first"]) & (y["end"] <= x["end"]) & (
            (y["priority"] < x["priority"]) | ((y["priority"] == x["priority"]) & (
                (y["end"] - -y["first"] < x["end"] - -x["first"]) | ((y["first"] == x["first"]) & (y["end"] == x["end"]) & (y["id"] < x["id"]))))))

    d = d.select("*", once(F.filter("_h", lambda x, i: ~covered(x, i))).alias("_kept"))
    firsts = F.transform(F.concat(*[F.col(f"_b{i}") for i in range(len(PHRASES))]), lambda x: x["first"].cast("long"))
    labels = F.array_compact(F.array(*[F.when(F.size(f"_b{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(PHRASES)]))
    every = F.array_sort(F.array_distinct(F.concat(labels, F.transform("_kept", lambda x: x["label"]))))
    best = F.array_max(F.concat(F.transform("_kept", lambda x: x["confidence"]), F.when(F.size(labels) > 0, F.array(F.lit(0.6))).otherwise(F.array().cast("array<double>"))))
    return d.select(F.col("_k").alias(key), "n_words", F.size(firsts).cast("long").alias("n_base"),
                    F.array_min(firsts).alias("first_word"), F.array_max(firsts).alias("last_word"),
                    F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
                    F.coalesce(best, F.lit(0.0)).alias("score"),
                    F.transform("_kept", lambda x: F.struct(x["label"].alias("label"), x["first"].alias("first"), (-x["end"]).alias("last"))).alias("spans"))
