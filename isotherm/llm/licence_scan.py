"""Licence scans: Dice coefficient over word bigrams against templates, pruned by size.

A text's units are its lines, its paragraphs (between blank lines) and the whole.
Units and templates are normalised alike: A-Z lower-cased, everything but a-z,
0-9 and line breaks a space. A unit with n word bigrams can reach the
threshold t only with templates of t / (2 - t) * n to (2 - t) / t * n bigrams; a
map from size to templates, made once, gives each unit its candidates, and a unit
without any is not cut into bigrams at all. Dice counts repeated bigrams as often
as both sides hold them. A unit matches its nearest templates, several if they tie.

A notice need not be a unit: it may lie within a line, or run over lines or paragraphs
beside other text. So a template that no unit matched is also sought in all runs of the
text's words, and the run with the greatest coefficient is taken (the first, if they
tie): each text counts a template once among runs. A run that reaches the threshold
holds t / (2 - t) of the template's n bigrams and is (2 - t) / t * n long at most, so only
places from which that many of the template's bigrams follow within that length are
starts, and from each start the coefficient is followed bigram by bigram. Of runs of
several templates that mostly overlap, the one with the most bigrams in common matches.
Only texts that hold one of a few words which no match can do without are searched.
Everything is one projection of DataFrame functions: no
join, no shuffle.

The templates are a bounded list that becomes part of the plan (TEMPLATE_BYTES).

Defined results: null and empty texts, and units of one word, match nothing;
equal units of a text count once; repeated rows are scanned each; an empty table
gives no rows; other columns are kept.
"""

from __future__ import annotations

import functools
import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.llm.licence_templates import TEMPLATES

THRESHOLD = 0.8
TEMPLATE_BYTES = 1 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def template_words(text: str) -> list[str]:
    low = text.translate(str.maketrans(_UPPER, _LOWER))
    return re.sub("[^a-z0-9]+", " ", low).split()


def template_bigrams(text: str) -> list[str]:
    words = template_words(text)
    return [f"{a} {b}" for a, b in zip(words, words[1:])]


def candidates_by_size(bigrams: list[list[str]], threshold: float) -> dict[int, list[int]]:
    """For each size of a unit, the templates that can reach the threshold."""
    found: dict[int, list[int]] = {}
    for k, grams in enumerate(bigrams):
        n = len(grams)
        for size in range(1, int(n * (2 - threshold) / threshold) + 2):
            # The most that sizes n and size allow.
            if n and 2.0 * min(n, size) / (n + size) >= threshold:
                found.setdefault(size, []).append(k)
    return found


@functools.lru_cache(maxsize=64)
def needed_words(bigrams: tuple[tuple[str, ...], ...], threshold: float) -> list[str]:
    """Words of which every text with a run that reaches the threshold holds one or more.

    Such a run holds threshold / (2 - threshold) of a template's bigrams at least, so
    words that leave fewer without them will do: of each template, long ones first.
    """
    found: list[str] = []
    for grams in bigrams:
        left = list(grams)
        least = threshold / (2 - threshold) * len(grams) - 1e-9
        without = lambda w: [g for g in left if w not in g.split(" ")]  # noqa: E731,B023
        for w in found:
            left = without(w)
        while left and len(left) >= least:
            w = max({w for g in left for w in g.split(" ")}, key=lambda w: (min(len(w), 7), -len(without(w)), w))
            found.append(w)
            left = without(w)
    return found


def _words(words: list[str]) -> str:
    """SQL of an array of words and bigrams of a-z and 0-9."""
    return "cast(array(" + ", ".join(f"'{w}'" for w in words) + ") as array<string>)"


def _let(value: F.Column, use) -> F.Column:
    """``use(value)``, where ``value`` is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def licence_matches(text_col: str, templates: list[tuple[str, str]] = TEMPLATES,
                    threshold: float = THRESHOLD) -> F.Column:
    """array<struct<licence, template, dice>>: of every unit the nearest templates, if they reach the threshold; then of runs."""
    if sum(len(t) for _, t in templates) > TEMPLATE_BYTES:
        raise ValueError(f"templates are beyond {TEMPLATE_BYTES} bytes")
    bigrams = [template_bigrams(t) for _, t in templates]
    by_size = candidates_by_size(bigrams, threshold)
    grams = F.expr("array(" + ", ".join(map(_words, bigrams)) + ")")
    names = F.array(*[F.lit(n) for n, _ in templates])
    candidates = F.expr("cast(map(" + ", ".join(f"{n}, array({', '.join(map(str, ks))})" for n, ks in by_size.items())
                        + ") as map<int, array<int>>)")

    clean = F.regexp_replace(F.translate(F.coalesce(F.col(text_col), F.lit("")), _UPPER, _LOWER), "[^a-z0-9\n]+", " ")
    joined = lambda p: F.trim(F.regexp_replace(p, "[ \n]+", " "))
    pairs_of = lambda w: F.transform(
        F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.concat(F.get(w, i - 1), F.lit(" "), F.get(w, i)))
    times = lambda side, g: F.size(F.filter(side, lambda x: x == g))

    def dice(unit, k):
        template = F.get(grams, k)
        common = F.aggregate(F.array_intersect(unit, template), F.lit(0),
                             lambda n, g: n + F.least(times(unit, g), times(template, g)))
        return (2 * common) / (F.size(unit) + F.size(template))

    def of_units(clean):
        units = F.array_distinct(F.concat(
            F.transform(F.split(clean, "\n"), lambda u: F.trim(u)), F.transform(F.split(clean, "\n ?\n"), joined), F.array(joined(clean))))
        words = F.filter(F.transform(units, lambda u: F.split(u, " ")),
                         lambda w: F.map_contains_key(candidates, F.size(w) - 1))
        scored = F.transform(F.transform(words, pairs_of), lambda unit: F.transform(
            F.element_at(candidates, F.size(unit)),
            lambda k: F.struct(F.get(names, k).alias("licence"), k.alias("template"), dice(unit, k).alias("dice"))))
        return F.flatten(F.transform(scored, lambda found: F.filter(found, lambda m: (m["dice"] >= threshold) & (
            m["dice"] == F.array_max(F.transform(found, lambda x: x["dice"]))))))

    # Distinct bigrams of a template that any run which reaches the threshold holds, at least.
    least = F.array(*[F.lit(max(1, math.ceil(threshold / (2 - threshold) * len(b) - 1e-9) - (len(b) - len(set(b)))))
                      for b in bigrams])
    numbers = F.array(*[F.lit(k) for k, b in enumerate(bigrams) if b]).cast("array<int>")

    # The common bigrams of a run that reaches the threshold, at least, and its length, at most.
    need = F.array(*[F.lit(max(1, math.ceil(threshold / (2 - threshold) * len(b) - 1e-9))) for b in bigrams])
    reach = F.array(*[F.lit(max(1, math.floor((2 - threshold) / threshold * len(b) + 1e-9))) for b in bigrams])

    def marked(places, template):
        """``places`` (i, g) as (i, prior), in order: the bigram at i counts in runs that start after ``prior``,
        where the last of as many equal ones as the template holds stands."""
        def of_gram(g):
            at = F.transform(F.filter(places, lambda x: x["g"] == g), lambda x: x["i"])
            return _let(F.struct(at.alias("at"), times(template, g).alias("c")), lambda one: F.transform(
                one["at"], lambda i, o: F.struct(i.alias("i"), F.coalesce(F.get(one["at"], o - one["c"]), F.lit(-1)).alias("prior"))))
        return F.array_sort(F.flatten(F.transform(F.array_distinct(F.transform(places, lambda x: x["g"])), of_gram)))

    def best_from(start, marks, k):
        """The best run from one start: (dice, low, high), low negative so that the first is the greatest of equal ones."""
        state = lambda *v: F.struct(*[x.alias(n) for x, n in zip(v, ("common", "dice", "high"))])

        def step(a, m):
            common = a["common"] + F.when(m["prior"] < start["i"], 1).otherwise(0)
            value = (2 * common) / (m["i"] - start["i"] + 1 + F.size(F.get(grams, k)))
            better = (m["i"] - start["i"] < F.get(reach, k)) & (value > a["dice"])
            return state(common, F.when(better, value).otherwise(a["dice"]), F.when(better, m["i"]).otherwise(a["high"]))

        run = F.aggregate(F.slice(marks, start["a"] + 1, F.get(reach, k)), state(F.lit(0), F.lit(0.0), F.lit(-1)), step)
        return _let(run, lambda r: F.struct(r["dice"].alias("dice"), (-start["i"]).alias("low"), r["high"].alias("high")))

    def run_of(text, k):
        template = F.get(grams, k)
        places = F.filter(F.transform(text, lambda g, i: F.struct(i.alias("i"), g.alias("g"))),
                          lambda h: F.array_contains(template, h["g"]))

        def from_places(at):
            starts = F.filter(F.transform(at, lambda h, a: F.struct(a.alias("a"), h["i"].alias("i"))), lambda h: F.coalesce(
                F.get(at, h["a"] + F.get(need, k) - 1)["i"] - h["i"] < F.get(reach, k), F.lit(False)))
            return _let(starts, lambda some: F.when(F.size(some) > 0, _let(marked(at, template), lambda marks: F.array_max(
                F.transform(some, lambda h: best_from(h, marks, k))))))

        return _let(_let(places, from_places), lambda r: F.struct(
            F.get(names, k).alias("licence"), k.alias("template"), r["dice"].alias("dice"),
            (-r["low"]).alias("low"), r["high"].alias("high")))

    def of_runs(clean):
        def common(r):
            return F.round(r["dice"] * (r["high"] - r["low"] + 1 + F.size(F.get(grams, r["template"]))))

        def hidden(r, runs):
            overlap = lambda x: F.least(x["high"], r["high"]) - F.greatest(x["low"], r["low"]) + 1
            return F.exists(runs, lambda x: (2 * overlap(x) > r["high"] - r["low"] + 1) & (
                (common(x) > common(r)) | ((common(x) == common(r)) & (x["dice"] > r["dice"]))))

        def search(text):
            held = F.array_intersect(text, F.expr(_words(sorted({g for b in bigrams for g in b}))))
            ks = _let(held, lambda some: F.filter(
                numbers, lambda k: F.size(F.array_intersect(some, F.get(grams, k))) >= F.get(least, k)))
            runs = F.filter(F.transform(ks, lambda k: run_of(text, k)), lambda r: r["dice"] >= threshold)
            return _let(runs, lambda all_runs: F.filter(all_runs, lambda r: ~hidden(r, all_runs)))

        # Each step is bound once: a lambda would work out an expression anew for every word.
        return _let(F.split(joined(clean), " "), lambda words: _let(pairs_of(words), search))

    def matches(clean):
        def may(line):
            held = F.lit(False)
            for w in needed_words(tuple(map(tuple, bigrams)), threshold):
                held |= F.contains(line, F.lit(f" {w} "))
            return held

        plain = lambda r: F.struct(r["licence"].alias("licence"), r["template"].alias("template"), r["dice"].alias("dice"))
        return _let(of_units(clean), lambda found: F.when(_let(
            F.concat(F.lit(" "), F.translate(clean, "\n", " "), F.lit(" ")), may) & F.contains(joined(clean), F.lit(" ")), F.concat(
            found, F.transform(F.filter(of_runs(clean), lambda r: ~F.exists(
                found, lambda m: m["template"] == r["template"])), plain))).otherwise(found))

    return _let(clean, matches)


def scan_licences(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD,
                  text_col: str = "text", name: str = "licences") -> DataFrame:
    """``docs`` with a column ``name`` of matches; a column of that name is replaced."""
    return docs.withColumn(name, licence_matches(text_col, templates, threshold))
