"""Licence scan: ordered signature rules behind a keyword prefilter, in DataFrame functions only.

A rule is a hand-written pattern over the words of a text, with a label, a priority and keywords of which one
must be in the text before the pattern is tried.  Detections are intervals of words; one that lies inside another
of the same or a higher priority is suppressed.  The rules come from the licences' names, each in the wordings
that announce a licence (:data:`WORDINGS`), several hundred in all.
"""

from __future__ import annotations

import json
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclewise.llm.common import ascii_lower, text_of

#: Between words: everything in ASCII that is neither digit nor lower-case letter.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrase -> label.  Every place of these counts as a base place, whatever other rules say.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: label, keywords (every match of the pattern holds one of them; a blank at an end is the end of a word), pattern of the licence's name (lower-case words, one blank between them).
NAMES = [
    ("mit", " mit ", r"(?:the )?mit(?: expat)?"),
    ("apache-2", "apache", r"(?:the )?apache(?: software)?(?: license)?(?: version| v)? ?2(?: 0)?"),
    ("apache-1.1", "apache", r"(?:the )?apache(?: software)?(?: license)?(?: version| v)? ?1 1"),
    ("gpl-2", " gpl|general public", r"(?:the )?(?:gnu )?(?:general public license|gpl)(?: version| v)? ?2(?: 0)?(?: only)?"),
    ("gpl-2-or-later", " gpl|general public", r"(?:the )?(?:gnu )?(?:general public license|gpl)(?: version| v)? ?2(?: 0)? or (?:at your option )?(?:any )?later(?: version)?"),
    ("gpl-3", " gpl|general public", r"(?:the )?(?:gnu )?(?:general public license|gpl)(?: version| v)? ?3(?: 0)?(?: only)?"),
    ("gpl-3-or-later", " gpl|general public", r"(?:the )?(?:gnu )?(?:general public license|gpl)(?: version| v)? ?3(?: 0)? or (?:at your option )?(?:any )?later(?: version)?"),
    ("gpl", " gpl|general public", r"(?:the )?(?:gnu (?:general public license|gpl)|gpl)"),
    ("lgpl-2.1", " lgpl|lesser general|library general", r"(?:the )?(?:gnu )?(?:(?:lesser|library) general public license|lgpl)(?: version| v)? ?2 1"),
    ("lgpl-3", " lgpl|lesser general|library general", r"(?:the )?(?:gnu )?(?:lesser general public license|lgpl)(?: version| v)? ?3(?: 0)?"),
    ("lgpl", " lgpl|lesser general|library general", r"(?:the )?(?:gnu )?(?:(?:lesser|library) general public license|lgpl)"),
    ("agpl-3", " agpl|affero", r"(?:the )?(?:gnu )?(?:affero general public license|agpl)(?: version| v)? ?3(?: 0)?"),
    ("agpl", " agpl|affero", r"(?:the )?(?:gnu )?(?:affero general public license|agpl)"),
    ("gfdl", "gnu f", r"(?:the )?gnu (?:free documentation license|fdl)(?: version| v)?(?: 1(?: [123])?)?"),
    ("bsd-2-clause", "bsd", r"(?:the )?(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)"),
    ("bsd-3-clause", "bsd", r"(?:the )?(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)"),
    ("bsd-4-clause", "bsd", r"(?:the )?(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)"),
    ("bsd-0-clause", "bsd", r"(?:the )?(?:bsd 0 clause|0bsd|zero clause bsd)"),
    ("bsd", "bsd", r"(?:the |a )?bsd(?: style)?"),
    ("isc", " isc ", r"(?:the )?isc"),
    ("mpl-2", "mozilla| mpl", r"(?:the )?(?:mozilla public license|mpl)(?: version| v)? ?2(?: 0)?"),
    ("mpl-1.1", "mozilla| mpl", r"(?:the )?(?:mozilla public license|mpl)(?: version| v)? ?1 1"),
    ("mpl", "mozilla| mpl", r"(?:the )?(?:mozilla public license|mpl)"),
    ("epl-2", "eclipse| epl", r"(?:the )?(?:eclipse public license|epl)(?: version| v)? ?2(?: 0)?"),
    ("epl-1", "eclipse| epl", r"(?:the )?(?:eclipse public license|epl)(?: version| v)? ?1(?: 0)?"),
    ("eupl-1.2", "european union public|eupl", r"(?:the )?(?:european union public licen[cs]e|eupl)(?: version| v)?(?: 1 2)?"),
    ("cddl", "common development|cddl", r"(?:the )?(?:common development and distribution license|cddl)(?: version| v)?(?: 1 [01])?"),
    ("cpl", "common public", r"(?:the )?common public license(?: version| v)?(?: 1(?: 0)?)?"),
    ("artistic-2", "artistic", r"(?:the )?artistic(?: license)?(?: version| v)? ?2(?: 0)?"),
    ("artistic", "artistic", r"(?:the )?(?:perl )?artistic"),
    ("boost-1", " boost ", r"(?:the )?boost(?: software)?(?: license)?(?: version| v)?(?: 1(?: 0)?)?"),
    ("zlib", " zlib ", r"(?:the )?zlib(?: libpng)?"),
    ("wtfpl", " wtfpl |what the fuck", r"(?:the )?(?:do what the fuck you want to public license|wtfpl)(?: version| v)?(?: 2)?"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("ms-pl", "microsoft|ms pl", r"(?:the )?(?:microsoft public license|ms pl)"),
    ("ms-rl", "microsoft|ms rl", r"(?:the )?(?:microsoft reciprocal license|ms rl)"),
    ("python-2", " python | psf ", r"(?:the )?(?:python(?: software foundation)?|psf)(?: license)?(?: version| v)?(?: 2(?: 0)?)?"),
    ("php-3", " php ", r"(?:the )?php(?: license)?(?: version| v)?(?: 3(?: 01)?)?"),
    ("ruby", " ruby ", r"(?:the )?ruby"),
    ("openssl", "openssl", r"(?:the )?openssl"),
    ("postgresql", "postgresql", r"(?:the )?postgresql"),
    ("ncsa", "ncsa", r"(?:the )?(?:university of illinois )?ncsa(?: open source)?"),
    ("ofl-1.1", " ofl |open font", r"(?:the )?(?:sil open font license|ofl)(?: version| v)?(?: 1 1)?"),
    ("odbl-1", "odbl|open database", r"(?:the )?(?:open database license|odbl)(?: version| v)?(?: 1(?: 0)?)?"),
    ("odc-by", "odc by|data commons", r"(?:the )?(?:open data commons attribution|odc by)(?: version| v)?(?: 1(?: 0)?)?"),
    ("pddl", "pddl|public domain dedication", r"(?:the )?(?:public domain dedication and license|pddl)"),
    ("cc0", "cc0|commons zero|commons 0", r"(?:the )?(?:creative commons zero|creative commons 0|cc0)(?: 1 0)?(?: universal)?"),
    ("cc-by", "creative commons| cc by ", r"(?:the )?(?:creative commons(?: license)?(?: attribution)?|cc) by(?: [1-4] [05])?"),
    ("cc-by", "creative commons", r"(?:the |a )?creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)?"),
    ("cc-by-sa", " cc by | commons by ", r"(?:the |a )?(?:creative commons|cc) by sa(?: [1-4] [05])?"),
    ("cc-by-sa", "creative commons", r"(?:the |a )?creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported| generic)?"),
    ("cc-by-nd", " cc by | commons by ", r"(?:the |a )?(?:creative commons|cc) by nd(?: [1-4] [05])?"),
    ("cc-by-nd", "creative commons", r"(?:the |a )?creative commons attribution no ?deriv(?:ative)?s(?: [1-4] [05])?(?: international| unported| generic)?"),
    ("cc-by-nc", " cc by | commons by ", r"(?:the |a )?(?:creative commons|cc) by nc(?: [1-4] [05])?"),
    ("cc-by-nc", "creative commons", r"(?:the |a )?creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported| generic)?"),
    ("cc-by-nc-sa", " cc by | commons by ", r"(?:the |a )?(?:creative commons|cc) by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "creative commons", r"(?:the |a )?creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: international| unported| generic)?"),
    ("cc-by-nc-nd", " cc by | commons by ", r"(?:the |a )?(?:creative commons|cc) by nc nd(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "creative commons", r"(?:the |a )?creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1-4] [05])?(?: international| unported| generic)?"),
    ("proprietary", "proprietary", r"(?:a |the )?proprietary(?: software)?(?: license)?"),
]

#: name of the wording, priority, keywords (as above; for "named" the licence word may also stand elsewhere in the text:
#: a bare name such as "Python 2" means a licence only in a text that speaks of one), words before and after the licence's name.
WORDINGS = [
    ("notice", 5, "is licensed|is released|is distributed|is published|is available|is made available|is free software", r"is (?:free software )?(?:licensed|released|distributed|published|available|made available) under (?:the terms of )?", r"(?: licen[cs]e)?"),
    ("spdx", 5, "spdx", r"spdx license identifier ", r""),
    ("granted", 4, "ed under|available under|ed by|available by", r"(?:licensed|released|distributed|published|available|shared|offered|provided|covered) (?:under|by) (?:the )?(?:terms (?:and conditions )?of )?", r"(?: licen[cs]e)?"),
    ("under", 3, " under | per | subject to ", r"(?:under|per|subject to) (?:the )?(?:terms of )?", r" licen[cs]e"),
    ("field", 3, "license|licence", r"licen[cs]e ", r"(?: licen[cs]e)?"),
    ("named", 2, "license|licence", r"", r" licen[cs]e"),
]

#: Labels that need no name, with their priority and keyword.
FREE = [
    ("all-rights-reserved", 2, "reserved", r"all rights reserved"),
    ("public-domain", 3, "domain", r"(?:(?:released|dedicated|placed) (?:in)?to the public domain|(?:this work is )?in the public domain)"),
    ("mit", 5, "hereby", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("bsd", 5, "redistribution", r"redistribution and use in source and binary forms with or without modification"),
    ("isc", 5, "permission to use", r"permission to use copy modify and or distribute this software for any purpose"),
    ("unlicense", 5, "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", 5, "everyone is permitted", r"everyone is permitted to copy and distribute verbatim or modified copies"),
    ("cc0", 4, "waive", r"(?:has )?waived? all copyright and related (?:or|and) neighboring rights"),
    ("gfdl", 5, "invariant", r"with no invariant sections no front cover texts and no back cover texts"),
    ("zlib", 5, "held liable", r"in no event will the authors be held liable for any damages arising from the use of this software"),
    ("boost-1", 5, "boost", r"distributed under the boost software license version 1 0"),
]

#: A word of a text that is not lower-cased yet.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

PRIORITIES = 5


def _keyword(keyword: str) -> str:
    """A keyword as it stands in the words of a text: two blanks between its words, a blank at its ends where it ends a word."""
    return " " * keyword.startswith(" ") + keyword.strip().replace(" ", "  ") + " " * keyword.endswith(" ")


def rules() -> list[dict]:
    """The rules in order, base phrases first: number, label, priority, base, two keyword gates, pattern over `` w1  w2 ``."""
    out = []

    def add(label, priority, base, first, second, pattern):
        # every word stands between two blanks of its own: one blank of the rule is two of the text
        body = pattern.replace(" ?", "(?: )?").replace(" ", "  ")
        out.append({"rule": len(out), "label": label, "priority": priority, "base": base, "pattern": f" {body} ",
                    "first": [_keyword(k) for k in first.split("|")], "second": [_keyword(k) for k in second.split("|")]})

    for phrase, label in BASE.items():
        add(label, PRIORITIES, True, phrase, phrase, phrase)
    for label, priority, keyword, pattern in FREE:
        add(label, priority, False, keyword, keyword, pattern)
    for _, priority, gate, before, after in WORDINGS:
        for label, keyword, name in NAMES:
            # a name that says "license" needs no further one
            said = after if after.endswith("?") or "license" not in name else f"(?:{after})?"
            add(label, priority, False, keyword, gate, before + name + said)
    return out


def _gated_rules(words: Column) -> Column:
    """The rules whose keywords are in the text: one look per keyword list, not per rule."""
    by_first: dict[str, list[dict]] = {}
    for r in rules():
        by_first.setdefault("|".join(r["first"]), []).append(r)
    groups = F.from_json(
        F.lit(json.dumps([{"first": rs[0]["first"], "rules": rs} for rs in by_first.values()])),
        "array<struct<first:array<string>,rules:array<struct<rule:int,label:string,priority:int,base:boolean,second:array<string>,pattern:string>>>>",
    )
    there = lambda ks: F.exists(ks, lambda k: F.contains(words, k))
    return F.filter(F.flatten(F.transform(F.filter(groups, lambda g: there(g["first"])), lambda g: g["rules"])), lambda r: there(r["second"]))


def words_of(text: Column) -> Column:
    """The text's words, each between two blanks; empty without words."""
    flat = F.trim(F.regexp_replace(ascii_lower(text), GAP, "  "))
    return F.when(flat == "", F.lit("")).otherwise(F.concat(F.lit(" "), flat, F.lit(" ")))


def _may_match(text: Column) -> Column:
    """Whether the text has the keywords of some rule: looser than :func:`_gated_rules`, from the same keywords.

    A first look takes the single words of the keywords in the lower-cased text, which needs no splitting;
    the second one the keywords themselves in the words of what is left.
    """
    seconds: dict[tuple, set] = {}
    for r in rules():
        seconds.setdefault(tuple(r["first"]) if r["first"] == r["second"] else (), set()).update(r["second"])
    named = {k for r in rules() if r["first"] != r["second"] for k in r["first"]}
    alone = {k for firsts, ks in seconds.items() if firsts for k in ks}

    def look(held: Column, has) -> Column:
        some = lambda ks: reduce(or_, [has(held, k) for k in sorted(ks)])
        return some(alone) | (some(named) & some(seconds[()]))

    every = lambda t, k: reduce(and_, [F.contains(t, F.lit(w)) for w in k.split()])
    whole = lambda t, k: F.contains(t, F.lit(k))
    # arrays of one text: it is lower-cased or split once for all looks
    return F.exists(F.array(ascii_lower(text)), lambda t: look(t, every)) & F.exists(F.array(words_of(text)), lambda t: look(t, whole))


def _count(words: Column) -> Column:
    return ((F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit("")))) / 2).cast("long")


def detections(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per detection that a text has: ``doc_id, text_hash, rule, label, priority, base, first_word,
    end_word, suppressed``.  Words count from 0, ``end_word`` is exclusive.  Rows repeated with id and text
    count once; null and empty texts have none.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(F.col(text_col)).alias("_text"))
    near = rows.filter(_may_match(F.col("_text"))).withColumn("text_hash", F.xxhash64("_text"))
    words = near.dropDuplicates(["doc_id", "text_hash"]).select("doc_id", "text_hash", words_of(F.col("_text")).alias("_words"))
    # the prefilter: only rules whose keywords are in the text are tried (explode_outer keeps Spark from trying them twice)
    tried = words.withColumn("_r", F.explode_outer(_gated_rules(F.col("_words"))))
    tried = tried.filter(F.expr("regexp_like(_words, _r.pattern)"))
    parts = tried.select(
        "doc_id", "text_hash", "_r.rule", "_r.label", "_r.priority", "_r.base",
        F.posexplode(F.expr("arrays_zip(split(_words, _r.pattern, -1), regexp_extract_all(_words, _r.pattern, 0))")).alias("_i", "_p"),
    ).select("doc_id", "text_hash", "rule", "label", "priority", "base", "_i",
             _count(F.col("_p")["0"]).alias("_gap"), F.coalesce(_count(F.col("_p")["1"]), F.lit(0)).alias("_hit"))
    w = Window.partitionBy("doc_id", "text_hash", "rule").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    spans = parts.withColumn("end_word", F.sum(F.col("_gap") + F.col("_hit")).over(w)).filter("_hit > 0").select(
        "doc_id", "text_hash", "rule", "label", "priority", "base", (F.col("end_word") - F.col("_hit")).alias("first_word"), "end_word"
    )
    # longer intervals first at a start: what ends at or before the farthest end so far lies inside that one
    order = Window.partitionBy("doc_id", "text_hash").orderBy("first_word", F.desc("end_word"), F.desc("priority"), "rule").rowsBetween(
        Window.unboundedPreceding, -1
    )
    inside = F.lit(False)
    for p in range(1, PRIORITIES + 1):
        far = F.max(F.when(F.col("priority") >= p, F.col("end_word"))).over(order)
        inside = inside | ((F.col("priority") == p) & F.coalesce(far >= F.col("end_word"), F.lit(False)))
    return spans.withColumn("suppressed", inside)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``base_labels`` holds the labels of all base places; ``labels`` these and those of the detections that are
    not suppressed, both distinct, sorted and joined by commas (empty without any).  ``score`` is the highest
    priority of a surviving detection over the highest there is, 0 without any.  Null texts count as empty.
    """
    found = detections(docs, id_col, text_col).groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_h")).agg(
        F.count_if("base").alias("_base"),
        F.min(F.when(F.col("base"), F.col("first_word"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("first_word"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("_bl"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base") | ~F.col("suppressed"), F.col("label")))), ",").alias("_l"),
        (F.max(F.when(~F.col("suppressed"), F.col("priority"))) / F.lit(float(PRIORITIES))).alias("_s"),
    )
    text = text_of(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("_th"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"))
    out = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("_h")), "left")
    return out.select(
        "doc_id", "n_words", F.coalesce("_base", F.lit(0)).cast("long").alias("n_base"), F.col("first_word").cast("long"),
        F.col("last_word").cast("long"), F.coalesce("_bl", F.lit("")).alias("base_labels"), F.coalesce("_l", F.lit("")).alias("labels"),
        F.coalesce("_s", F.lit(0.0)).alias("score"),
    )
