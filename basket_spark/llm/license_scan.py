"""License scan by ordered signature rules (native).

Texts become lower-case words with one blank between them. Those that hold a gate word are tried with the rules whose
keyword they hold; detections inside a longer one, or on the same words as one of better priority, are suppressed. All of
it is one expression over a row: no join, no shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import narrow
from .license_rules import RULES

#: What the base labels come from.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: ASCII but digits and letters, each by itself: Java looks such a class up in a bitmap.
_SEPARATORS = "[" + "".join(rf"\x{i:02X}" for i in range(128) if not chr(i).isalnum()) + "]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PHRASE = f" ({'|'.join(PHRASES)})(?= )"
#: Starts of words one of which stands wherever a rule or phrase does; few texts without a notice hold any.
GATES = ("licen", "unlicense", "gpl", "lgpl", "agpl", "cc by", "cc0", "creative commons", "public domain", "bsd", "wtfpl", "under apache", "under mit", "under the mit", "under x11", "under the x11", "under expat", "under the expat", "released under", "distributed under", "permission", "redistribution and", "all rights reserved", "proprietary and", "confidential and", "copyright", "spdx", "cecill", "openrail", "bigscience", "creativeml", "mulan", "commons clause", "this software is provided as is", "www apache org", "www gnu org", "apache software", "eupl", "cddl", *(f"{x}{y}" for x in ("apache", "mpl", "epl", "ofl", "osl", "afl", "sspl", "upl") for y in ("1", "2", "3", "v1", "v2", "v3", " 1", " 2", " 3", " v", " ver", " the v")))


_PLUS = r"(?<=[0-9])\+"


def _spaced(text: Column) -> Column:
    """The words with one blank before each and one behind the last."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(text, _SEPARATORS, " ")), F.lit(" "))


def blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _running(values: Column, combine: Callable[[Column, Column], Column], nothing: Column) -> Column:
    """The running results of an associative ``combine`` along an array, in log2(size) passes over it.

    ``nothing`` combines with any value to that value. Each pass combines every place with the one 1, 2, 4, ... before it.
    """

    def add(a: Column, k: Column) -> Column:
        return F.zip_with(a, F.slice(F.concat(F.array_repeat(nothing, F.pow(F.lit(2), k).cast("int")), a), F.lit(1), F.size(a)), combine)

    passes = F.filter(F.sequence(F.lit(0), F.lit(30)), lambda k: F.pow(F.lit(2), k) < F.size(values))
    return F.aggregate(passes, values, add)


def _detections(words: Column, rules: list[tuple[int, str, str, str, float]]) -> Column:
    """Array of (start, last, priority, label, confidence), in characters of ``words``; ``last`` is the end, negative."""
    fields = ("priority", "label", "keyword", "pattern", "confidence")
    text = json.dumps([dict(zip(fields, (p, label, k, f" (?:{x})(?= )", c), strict=True)) for p, label, k, x, c in rules])
    table = F.from_json(F.lit(text), "array<struct<priority:int,label:string,keyword:string,pattern:string,confidence:double>>")  # one literal

    def places(rule: Column) -> Column:
        hits = F.transform(F.regexp_extract_all(words, rule["pattern"], F.lit(0)), F.length)
        gaps = F.transform(F.split(words, rule["pattern"]), F.length)
        steps = F.filter(F.zip_with(gaps, hits, lambda gap, hit: F.struct((gap + hit).alias("both"), hit.alias("hit"))), lambda s: s["hit"].isNotNull())
        ends = F.transform(F.array(steps), lambda s: F.arrays_zip(s.alias("s"), _running(F.transform(s, lambda x: x["both"]), lambda a, b: a + b, F.lit(0)).alias("end")))
        return F.transform(F.flatten(ends), lambda x: F.struct((x["end"] - x["s"]["hit"]).alias("start"), (-x["end"]).alias("last"), rule["priority"].alias("priority"), rule["label"].alias("label"), rule["confidence"].alias("confidence")))

    return F.flatten(F.transform(F.filter(table, lambda r: F.contains(words, r["keyword"])), places))


def _surviving(found: Column) -> Column:
    """Without the detections inside a longer one, and without those that another of better priority covers exactly.

    ``found`` is sorted: by start, the longer first, then by priority. Of all up to a detection the one of the furthest
    end, the first such one, is compared with it: it beats the detection if it isn't of the same place and priority.
    """
    reach = _running(F.transform(found, lambda d: F.struct((-d["last"]).alias("end"), (-d["start"]).alias("start"), (-d["priority"]).alias("priority"))), lambda a, b: F.greatest(a, b), F.lit(None))
    same = lambda x: (x["reach"]["end"] == -x["d"]["last"]) & (x["reach"]["start"] == -x["d"]["start"]) & (x["reach"]["priority"] == -x["d"]["priority"])
    return F.transform(F.filter(F.zip_with(found, reach, lambda d, r: F.struct(d.alias("d"), r.alias("reach"))), same), lambda x: x["d"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[tuple[int, str, str, str, float]] = RULES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    ``score`` is the best confidence among the surviving detections (0.8 at least where a base phrase stands), 0
    without any. Null texts are empty; repeated rows and null ids each give a row.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col)
    spaced = rows.select("doc_id", "text", _spaced(F.coalesce("text", F.lit(""))).alias("words"))
    empty = F.col("words") == "  "
    gate = F.lower("words").rlike(f" (?:{'|'.join(GATES)})")
    lower = F.translate("words", _UPPER, _LOWER)
    # What the rules read has a word for the plus of "GPLv2+"; positions and counts are those of the words proper.
    ruled = F.translate(_spaced(F.regexp_replace("text", _PLUS, " plus ")), _UPPER, _LOWER)
    gated = spaced.select("doc_id", F.when(empty, 0).otherwise(blanks(F.col("words")) - 1).cast("long").alias("n_words"), F.when(gate, lower).alias("words"), F.when(gate, F.when(F.col("text").rlike(_PLUS), ruled).otherwise(lower)).alias("ruled"))
    words = F.col("words")
    base = gated.select("doc_id", "n_words", "words", F.regexp_extract_all("words", F.lit(_PHRASE), F.lit(1)).alias("base"), F.when(words.isNotNull(), F.array_sort(_detections(F.col("ruled"), rules))).alias("found"))
    kept = base.select("doc_id", "n_words", "words", F.coalesce("base", F.array().cast("array<string>")).alias("base"), _surviving(F.col("found")).alias("found"))
    label_of = F.create_map([F.lit(x) for pair in PHRASES.items() for x in pair])
    any_base = F.size("base") > 0
    joined = kept.select("doc_id", "n_words", "words", "base", F.array_sort(F.array_distinct(F.transform("base", lambda p: label_of[p]))).alias("base_labels"), F.coalesce(F.transform("found", lambda d: d["label"]), F.array().cast("array<string>")).alias("more"), F.coalesce(F.array_max(F.transform("found", lambda d: d["confidence"])), F.lit(0.0)).alias("best"))
    return joined.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.when(any_base, blanks(F.get(F.split("words", _PHRASE, 2), F.lit(0)))).cast("long").alias("first_word"),
        F.when(any_base, blanks(F.regexp_extract("words", f"(?s)^(.*){_PHRASE}", 1))).cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_labels", "more")), ",").alias("labels"),
        F.greatest(F.col("best"), F.when(any_base, 0.8).otherwise(0.0)).cast("double").alias("score"),
    )
