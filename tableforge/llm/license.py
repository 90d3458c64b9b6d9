"""License scans with DataFrame functions only.

The rules (license_rules) are hand-written regular expressions over normalised words, each with a level and the words
that every match of it holds. Texts pass a gate made of these words first: plain substring tests, short of what a text
must hold for any rule to match. Those that pass are normalised to lower-case words parted by single blanks, and only
rules all of whose words occur are run. A detection that lies within another of the same or a higher level is
suppressed. Detections, suppression and word positions are array functions within the row: no shuffle, so no key can be
hot.

Null text is empty text: no words, no labels, score 0. Repeated rows are scanned one by one; ties (equal spans) keep the
rule with the higher level, then the first rule. Very long texts are scanned whole. Only the id and text columns are
read.
"""

from __future__ import annotations

import json
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableforge.llm import common
from tableforge.llm.license_rules import RULES_TEXT

#: The phrases that always count, with their labels.
BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]


def parsed(lines: str) -> list[dict]:
    fields = [line.split("; ", 3) for line in lines.strip().splitlines()]
    needle = lambda w: f" {w[:-1]}" if w.endswith("~") else f" {w} "
    return [{"id": k, "label": label, "level": int(level), "words": words.split(), "needles": list(map(needle, words.split())), "regex": f" (?:{regex})(?= )"} for k, (label, level, words, regex) in enumerate(fields)]


RULES = parsed(RULES_TEXT)
KEYWORDS = sorted({w for r in RULES for w in r["words"]})
NEEDLES = sorted({n for r in RULES for n in r["needles"]})
WEIGHTS = {1: 0.5, 2: 0.9, 3: 1.0}


def gate_sets(rules: list[dict], stem: str = "licen") -> list[list[str]]:
    """What the gate asks for: the least sets of substrings of which every rule's matches hold one. A word counts as the
    shortest rule's word within it that is more than half of it; words of licensing are one substring, and enough."""
    words = [w for w in KEYWORDS if len(w) > 2 and stem not in w and "~" not in w]
    short = lambda w: min((k for k in words if k in w and 2 * len(k) > len(w)), key=lambda k: (len(k), k), default=w.rstrip("~"))
    sets = {frozenset([stem]) if any(stem in w for w in r["words"]) else frozenset(map(short, r["words"])) for r in rules}
    least = [s for s in sets if not any(t < s for t in sets)]
    return sorted(sorted(s, key=lambda w: (-len(w), w)) for s in least)


GATE = gate_sets(RULES)

_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def places(words: Column, regex: Column) -> Column:
    """array<struct<s, e>>: first word and the word behind, of all matches of ``regex`` (which begins with a blank and
    ends before one) in blank-parted words."""
    none = F.expr("cast(array() as array<struct<s:int,e:int>>)")
    step = lambda a, x: F.struct(
        (a["at"] + x["skip"] + x["n"]).alias("at"),
        F.concat(a["out"], F.array(F.struct((a["at"] + x["skip"]).alias("s"), (a["at"] + x["skip"] + x["n"]).alias("e")))).alias("out"),
    )

    def placed(found: Column) -> Column:
        before = F.slice(F.split(words, regex, -1), 1, F.size(found))
        counts = F.zip_with(before, found, lambda b, m: F.struct(_blanks(b).alias("skip"), _blanks(m).alias("n")))
        return F.aggregate(counts, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda a: a["out"])

    found = F.regexp_extract_all(words, F.concat(F.lit("("), regex, F.lit(")")), F.lit(1))
    # the one-element array gives the matches a name, so that they are sought once
    return F.flatten(F.transform(F.array(found), lambda f: F.when(F.size(f) > 0, placed(f)).otherwise(none)))


def unsuppressed(found: Column) -> Column:
    """Detections that don't lie within another of the same or a higher level, by one sweep from left to right."""
    order = F.array_sort(F.transform(found, lambda d: F.struct(d["s"].alias("s"), (-d["e"]).alias("e"), (-d["level"]).alias("level"), d["id"].alias("id"), d["label"].alias("label"))))
    kept = "array<struct<s:int,e:int,level:int,id:int,label:string>>"
    start = F.struct(*[F.lit(-1).alias(f"m{k}") for k in (1, 2, 3)], F.expr(f"cast(array() as {kept})").alias("out"))

    def step(a: Column, d: Column) -> Column:
        e, level = -d["e"], -d["level"]
        covered = F.when(level == 1, a["m1"]).when(level == 2, a["m2"]).otherwise(a["m3"]) >= e
        item = F.array(F.struct(d["s"].alias("s"), e.alias("e"), level.alias("level"), d["id"].alias("id"), d["label"].alias("label")))
        reach = [F.when(level >= k, F.greatest(a[f"m{k}"], e)).otherwise(a[f"m{k}"]).alias(f"m{k}") for k in (1, 2, 3)]
        return F.struct(*reach, F.when(covered, a["out"]).otherwise(F.concat(a["out"], item)).alias("out"))

    return F.aggregate(order, start, step, lambda a: a["out"])


def license_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_base, first_word, last_word, base_labels, labels, score and the detections (first word, word
    behind, level, rule id, label)."""
    docs = df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_t")).withColumn("_low", F.lower("_t"))
    has = lambda some: reduce(and_, [F.contains("_low", F.lit(w)) for w in some])
    docs = docs.withColumn("_open", reduce(or_, map(has, GATE)))
    # only A-Z is lower-cased; where each character is one byte that is all that lower() does
    small = F.when(F.octet_length("_t") == F.length("_t"), F.col("_low")).otherwise(F.translate("_t", _UPPER, _SMALL))
    docs = docs.withColumn("_w", F.when(F.col("_open"), F.regexp_replace(F.concat(F.lit(" "), small, F.lit(" ")), _GAP, " ")))
    docs = docs.withColumn("_k", F.when(F.col("_w").isNotNull(), F.filter(F.array(*map(F.lit, NEEDLES)), lambda k: F.contains(F.col("_w"), k))))
    rules = F.from_json(F.lit(json.dumps(RULES)), "array<struct<id:int,label:string,level:int,needles:array<string>,regex:string>>")
    chosen = F.filter(rules, lambda r: F.forall(r["needles"], lambda n: F.array_contains(F.col("_k"), n)))
    hit = lambda r: F.transform(places(F.col("_w"), r["regex"]), lambda p: F.struct(p["s"].alias("s"), p["e"].alias("e"), r["level"].alias("level"), r["id"].alias("id"), r["label"].alias("label")))
    docs = docs.withColumn("_d", F.when(F.size("_k") > 0, F.flatten(F.transform(chosen, hit))))
    docs = docs.withColumn("detections", F.when(F.col("_d").isNotNull(), unsuppressed(F.col("_d"))))
    labelled = lambda phrase, label: F.transform(places(F.col("_w"), F.lit(f" {phrase}(?= )")), lambda p: F.struct(p["s"].alias("s"), F.lit(label).alias("label")))
    base = [labelled(phrase, label) for phrase, label in BASE]
    docs = docs.withColumn("_b", F.when(F.col("_w").isNotNull(), F.concat(*base)))
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    none = F.expr("cast(array() as array<string>)")
    base_labels = F.coalesce(F.transform("_b", lambda b: b["label"]), none)
    found_labels = F.coalesce(F.transform("detections", lambda d: d["label"]), none)
    weight = F.coalesce(F.array_max(F.transform("detections", lambda d: F.element_at(F.create_map(*[F.lit(x) for kv in WEIGHTS.items() for x in kv]), d["level"]))), F.lit(0.0))
    return docs.select(
        id_col,
        F.regexp_count("_t", F.lit(_WORD)).cast("long").alias("n_words"),
        F.when(F.col("_b").isNull(), 0).otherwise(F.size("_b")).cast("long").alias("n_base"),
        F.array_min(F.transform("_b", lambda b: b["s"])).cast("long").alias("first_word"),
        F.array_max(F.transform("_b", lambda b: b["s"])).cast("long").alias("last_word"),
        joined(base_labels).alias("base_labels"),
        joined(F.concat(base_labels, found_labels)).alias("labels"),
        F.greatest(weight, F.when(F.size("_b") > 0, 0.9).otherwise(0.0)).alias("score"),
        "detections",
    )


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    return license_scan(common.documents(spark, sf_dir)).drop("detections")
