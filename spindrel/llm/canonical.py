"""Mapping free-entered values to a canonical list, by token repair and soft TF-IDF.

Values and names are cut into tokens in the same way. Every distinct token is then joined to the vocabulary, the
tokens of all names, by edit distance: through the forms that remain of either when up to two letters are left out,
followed by the distance itself. A token can also be the beginning of a single word, and a long one that is no
word is cut at the words it holds, whose gaps are repaired in turn. No part of this knows the list's content; the list,
its forms and the tokens are tables and are joined as tables.

The repaired tokens of a value are compared with the names that hold one of its telling words. A name's score is the soft
TF-IDF cosine: the weights of common words, times how well they agree, over the lengths of both sides. Words outside the
vocabulary weigh nothing, words of the vocabulary that a name does not have speak against it. The best entry is taken if
enough of its name is there, if little of the value's vocabulary is left over, and if no other entry comes as close;
otherwise the value is ``unmatched``, as it names another thing, two, or none.
"""

from __future__ import annotations

import itertools
import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindrel.llm.words import clean
from spindrel.runtime import checkpoint, filled

UNMATCHED = "unmatched"
BROADCAST_CHARS = 16_000_000
ACCEPT = 0.75  # least share of a name's weight that a value must hold
LEFT = 0.14  # most share of a value's weight (squared) that a name may leave over
COVER = 0.6  # least share of a cut token's letters that its parts explain
MARGIN = 0.03  # least lead of the best entry over the next
SHORTENED = 0.95  # agreement of a shortened word

# Letters of other scripts that look like Latin ones, Greek letters that stand for themselves, Roman numbers,
# and the words that introduce a number.
_LIKE = str.maketrans(
    "аеорсухіјѕԁһкмтвнАВЕКМНОРСТУХІЈЅοΟιΙκΚνΝρΡτΤυΥχΧΕΖΗΜ",
    "aeopcyxijsdhkmtbhABEKMHOPCTYXIJSoOiIkKvNpPtTuYxXEZHM",
)
_GREEK = {"α": "alpha", "Α": "alpha", "β": "beta", "Β": "beta", "γ": "gamma", "Γ": "gamma"}
_ROMAN = {"i": "1", "ii": "2", "iii": "3", "iv": "4", "v": "5"}
_TYPE = {"type", "subtype", "t"}

_CHUNK = re.compile(r"[A-Za-z0-9]+")
_PIECE = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_NUMBERED = re.compile(r"(?:(?:sub)?type|t(?!i$))(\d+|i{1,3}|iv)")
_BRACKETED = re.compile(r"\(\s*(\d|i{1,3}|iv)\s*\)", re.I)
_DIGITS = re.compile(r"\D")
_LONG = 7  # a token of so many letters that is no word may hold several
_TOKEN = "chunk int, whole string, token string, dotted boolean"


def plain(text: str) -> str:
    """Latin letters without marks; Greek letters that stand for themselves are spelled out."""
    text = clean(text)
    if not text.isascii():
        text = re.sub(r"[αΑβΒγΓ](?=$|[\W\d_]|[A-Z]\d)", lambda m: f" {_GREEK[m[0]]} ", text)
        text = unicodedata.normalize("NFKD", text.translate(_LIKE))
        text = "".join(c for c in text if not unicodedata.combining(c))
    return text


def tokens(text: str) -> list[tuple[int, str, str, bool]]:
    """``(number of the chunk, chunk, token, does a full stop follow)``.

    A chunk is a run of letters and digits, cut where capitals begin and at numbers. A number belongs to the word before
    it (``cluster 13`` is ``cluster13``); types and subtypes, however written (``T2``, ``type-II``, ``(2)``), are ``type2``.
    """
    out: list[tuple[int, str, str, bool]] = []
    text = _BRACKETED.sub(lambda m: f" type {m[1]} ", plain(text))
    for k, m in enumerate(_CHUNK.finditer(text)):
        whole, dotted = m[0].lower(), text[m.end() : m.end() + 1] == "."
        if dotted and len(whole) == 1:
            continue  # a letter of an abbreviation such as n.b.
        pieces = [p.lower() for p in _PIECE.findall(m[0])]
        for i, p in enumerate(pieces):
            if n := _NUMBERED.fullmatch(p):
                p = "type" + _ROMAN.get(n[1], n[1])
            number = _ROMAN.get(p, p)
            if number.isdigit() and out and out[-1][2] in _TYPE:
                out[-1] = (out[-1][0], out[-1][1], "type" + number, False)
                if out[-1][0] != k:
                    continue
            elif p.isdigit() and out and (out[-1][0] == k or not out[-1][2][-1:].isdigit()):
                out[-1] = (out[-1][0], out[-1][1], out[-1][2] + p, False)
            else:
                out.append((k, whole, p, dotted and i == len(pieces) - 1))
    return out


def folded(word: str) -> str:
    """Characters that are read for each other made one."""
    return word.replace("0", "o").replace("1", "l").replace("rn", "m").replace("vv", "w")


def distance(a: str, b: str, most: int) -> int:
    """Edits, exchanges of neighbours included, between two words; ``most + 1`` if there are more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            now.append(d)
        if min(now) > most:
            return most + 1
        before, last = last, now
    return min(last[-1], most + 1)


def allowed(word: str) -> int:
    """How many edits a word of this length may have."""
    return 0 if len(word) < 4 else 1 if len(word) < 6 else 2


def remains(word: str, most: int) -> set[str]:
    """The word with up to ``most`` letters left out."""
    out = {word}
    for k in range(1, most + 1):
        out |= {"".join(word[i] for i in keep) for keep in itertools.combinations(range(len(word)), len(word) - k)}
    return out


def _each(df: DataFrame, column: str, make, schema: str) -> DataFrame:  # noqa: ANN001
    """Rows of ``df`` with the rows that ``make`` gives for a column's value."""
    kept = [c for c in df.columns]
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made = [make(v) for v in b[column]]
            at = np.repeat(np.arange(len(b)), [len(m) for m in made])
            flat = [r for m in made for r in m]
            new = {n: [r[i] for r in flat] for i, n in enumerate(names)}
            yield pd.DataFrame({**{c: b[c].to_numpy()[at] for c in kept}, **new})

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(run, f"{types}, {schema}")


class Canon:
    """The tables of a canonical list, for ``entries(type_key, display_name, synonyms, parent)``.

    ``names``: ``name_id, type_key, words`` with their weights; ``words``: ``word, weight, spread`` - a word of one name
    alone that stands for itself has spread 0 and is not repaired, as it is an abbreviation; ``postings``: ``word, name_id``
    for the telling words of each name, without which its score cannot reach ``ACCEPT``.
    """

    def __init__(self, entries: DataFrame) -> None:
        given = entries.where("type_key is not null").select("type_key", F.explode(F.concat(F.array("type_key", "display_name"), F.coalesce("synonyms", F.array().cast("array<string>")))).alias("name"))
        given = given.where(filled("name")).distinct()

        def words_of(name: str) -> list[tuple[list[str]]]:
            found = tokens(name)
            single = not re.search(r"[\s_]", name.strip())
            whole = list(dict.fromkeys((k, w) for k, w, _, _ in found)) if single else []
            words = [w for _, w in whole] if single else [t for _, _, t, _ in found]
            return [(sorted(words),)] if words else []

        names = _each(given, "name", words_of, "words array<string>").select("type_key", "words").distinct()
        names = names.withColumn("name_id", F.xxhash64("type_key", "words"))
        n = names.select("words").distinct().count()
        per = names.select("words", F.explode(F.array_distinct("words")).alias("word")).distinct()
        words = per.groupBy("word").agg(F.count(F.lit(1)).alias("df"), F.max(F.size("words")).alias("longest"))
        self.words = checkpoint(words.select(
            "word", F.greatest(F.log((F.lit(float(n)) + F.col("df")) / (2 * F.col("df"))), F.lit(0.1)).alias("weight"),  # near 0 for a word of all names
            F.when((F.col("longest") > 1) | (F.length("word") > 9), F.col("df")).otherwise(0).alias("spread"),
        ))
        weighed = names.select("name_id", "type_key", F.explode("words").alias("word")).join(self.words.select("word", "weight"), "word")
        top = Window.partitionBy("name_id").orderBy(F.desc("weight"), "word").rowsBetween(0, Window.unboundedFollowing)
        whole = Window.partitionBy("name_id")
        marked = weighed.withColumn("rest", F.sum("weight").over(top)).withColumn("total", F.sum("weight").over(whole))
        marked = checkpoint(marked)
        self.postings = marked.where(F.col("rest") >= ACCEPT * F.col("total") - 1e-9).select("word", "name_id").distinct()
        self.names = marked.groupBy("name_id", "type_key").agg(F.collect_list(F.struct("word", "weight")).alias("words"))
        self.longest = self.words.agg(F.max(F.length("word"))).first()[0] or 0
        # Words that carry numbers in the list.
        self.bound = self.words.select(F.regexp_extract("word", r"^([a-z]+)\d+$", 1).alias("b")).where("b <> ''").select("b").distinct()
        self.unseen = max(math.log((1 + n) / 2), 0.1)


def _forms(df: DataFrame, column: str) -> DataFrame:
    """``form`` for each remaining form of a word and of the word as it may be read."""
    return _each(df, column, lambda w: [(f,) for f in {r for x in {w, folded(w)} for r in remains(x, allowed(x))}], "form string")


def _near(tokens_: DataFrame, canon: Canon) -> DataFrame:
    """``token, word, sim``: the words nearest to each token, all of those at the least distance.

    Tokens longer than any word by more than the edits allowed are near none, so they have no forms. Numbers are not
    repaired: both have the same, but for those that are read for letters.
    """
    exact = tokens_.join(canon.words.select(F.col("word").alias("token")), "token", "left_semi").select("token", F.col("token").alias("word"), F.lit(1.0).alias("sim"))
    rest = tokens_.join(canon.words.select(F.col("word").alias("token")), "token", "left_anti").where((F.length("token") <= canon.longest + 4) & (F.length("token") >= 4))
    left = _forms(rest.select("token"), "token")
    right = _forms(canon.words.where("spread > 0 and length(word) >= 4").select("word"), "word")
    pairs = left.join(right, "form").select("token", "word").distinct()

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            d = []
            for t, w in zip(b["token"], b["word"], strict=True):
                most, x, y = min(allowed(t), allowed(w)), folded(t), folded(w)
                e = min(distance(t, w, most), distance(x, y, most)) if _DIGITS.sub("", x) == _DIGITS.sub("", y) else most + 1
                d.append(e if e <= most else -1)
            yield b.assign(d=np.array(d, np.int32))

    found = pairs.mapInPandas(measure, "token string, word string, d int").where("d >= 0")
    least = F.min("d").over(Window.partitionBy("token"))
    best = found.withColumn("least", least).where("d = least")
    sim = 1 - F.col("d") / F.greatest(F.length("token"), F.length("word"))
    return exact.unionByName(best.select("token", "word", sim.alias("sim")))


def _shortened(rest: DataFrame, canon: Canon) -> DataFrame:
    """``token, word, sim`` for tokens that begin one word alone: any with a full stop, else one of several names."""
    starts = canon.words.where("spread > 0 and length(word) >= 5").select(
        "word", "spread", F.explode(F.transform(F.sequence(F.lit(3), F.length("word") - 1), lambda k: F.substring("word", F.lit(1), k))).alias("token")
    )
    hit = rest.join(starts, "token").where((F.col("spread") > 1) & (F.length("token") >= 4) | F.col("dotted"))
    one = hit.groupBy("token").agg(F.countDistinct("word").alias("n"), F.min("word").alias("word")).where("n = 1")
    return one.select("token", "word", F.lit(SHORTENED).alias("sim"))


def _cut(token: str, words: list[str]) -> list[str]:
    """The token cut at words it holds, the longest cover first; gaps are parts of their own.

    Words of fewer than four letters are only taken where they fill a gap or begin the token.
    """
    ends: dict[int, list[str]] = {}
    for w in words:
        i = token.find(w) if len(w) >= 4 else -1
        while i >= 0:
            ends.setdefault(i + len(w), []).append(w)
            i = token.find(w, i + 1)
    best, last = [(0, 0)], [""]  # letters covered and words used up to each place, and the word that ends there
    for end in range(1, len(token) + 1):
        options = [(*best[end - 1], "")] + [(best[end - len(w)][0] + len(w), best[end - len(w)][1] - 1, w) for w in ends.get(end, ())]
        covered, used, word = max(options)
        best.append((covered, used))
        last.append(word)
    chosen, end = [], len(token)
    while end:
        if last[end]:
            chosen.append((end - len(last[end]), last[end]))
        end -= max(len(last[end]), 1)
    parts, at = [], 0
    for a, w in reversed(chosen):
        parts += [token[at:a], w] if a > at else [w]
        at = a + len(w)
    if at < len(token):
        parts.append(token[at:])
    out: list[str] = []
    short = sorted((w for w in words if 2 <= len(w) < 4), key=len, reverse=True)
    tiles = re.compile("(?:" + "|".join(map(re.escape, short)) + ")+") if short else None
    for i, p in enumerate(parts):
        if p not in words and tiles and tiles.fullmatch(p):
            out += re.findall("|".join(map(re.escape, short)), p)
        elif i == 0 and p not in words and (s := next((w for w in short if p.startswith(w) and len(p) - len(w) >= 4), None)):
            out += [s, p[len(s) :]]
        else:
            out.append(p)
    return [("type" + _ROMAN.get(m[1], m[1])) if (m := _NUMBERED.fullmatch(p)) else p for p in out if p]


def _parts(long: DataFrame, canon: Canon) -> DataFrame:
    """``token, at, part`` for long tokens that hold words of the vocabulary."""
    longest = canon.longest
    subs = _each(long.select("token"), "token", lambda t: [(w,) for w in {t[i : i + k] for k in range(2, min(len(t), longest) + 1) for i in range(len(t) - k + 1)}], "word string")
    held = subs.join(canon.words.where("spread > 0 or length(word) < 4").select("word"), "word")
    grouped = held.groupBy("token").agg(F.collect_set("word").alias("words")).where(F.exists("words", lambda w: F.length(w) >= 4))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(t, i, p) for t, w in zip(b["token"], b["words"], strict=True) for i, p in enumerate(_cut(t, sorted(w)))]
            yield pd.DataFrame(rows, columns=["token", "at", "part"])

    return grouped.mapInPandas(cut, "token string, at int, part string")


def repairs(found: DataFrame, canon: Canon) -> DataFrame:
    """``token, slots, cut``: what each of ``found(token, dotted)`` says, as one slot or, for cut tokens, several.

    A slot is an array of ``word, sim, weight``, the words that it can stand for. Tokens that say nothing are absent. A number
    that the list does not have, behind a word that carries numbers in it, is a slot with a word of its own.
    """
    found = checkpoint(found.groupBy("token").agg(F.max("dotted").alias("dotted")))
    near = checkpoint(_near(found.select("token"), canon))
    rest = found.join(near.select("token").distinct(), "token", "left_anti")
    short = _shortened(rest, canon)
    first = checkpoint(near.unionByName(short))
    rest = rest.join(first.select("token").distinct(), "token", "left_anti")
    parts = checkpoint(_parts(rest.where(F.length("token") >= _LONG).select("token"), canon))
    gaps = parts.select(F.col("part").alias("token"), F.lit(True).alias("dotted")).distinct()
    inner = _near(gaps.select("token"), canon)
    inner = checkpoint(inner.unionByName(_shortened(gaps.join(inner.select("token").distinct(), "token", "left_anti"), canon)))
    numbered = F.regexp_extract("token", r"^([a-z]+)\d+$", 1)
    counted = lambda df: df.withColumn("b", numbered).join(canon.bound, "b", "left_semi").join(canon.words.select(F.col("word").alias("token")), "token", "left_anti")
    other = counted(rest.select("token")).select("token", F.col("token").alias("word"), F.lit(1.0).alias("sim"))
    other_inner = counted(gaps.select("token")).select("token", F.col("token").alias("word"), F.lit(1.0).alias("sim"))
    weigh = lambda df: df.join(canon.words.select("word", "weight"), "word", "left").withColumn("weight", F.coalesce("weight", F.lit(canon.unseen)))
    slot = F.sort_array(F.collect_list(F.struct("word", "sim", "weight")))
    one = weigh(first.unionByName(other)).groupBy("token").agg(slot.alias("slot")).select("token", F.array("slot").alias("slots"))
    said = weigh(inner.unionByName(other_inner)).groupBy(F.col("token").alias("part")).agg(slot.alias("slot"))
    many = parts.join(said, "part").groupBy("token").agg(F.sort_array(F.collect_list(F.struct("at", "slot"))).alias("s"), F.sum(F.length("part")).alias("n"))
    many = many.where(F.col("n") >= COVER * F.length("token")).select("token", F.col("s.slot").alias("slots"), F.lit(True).alias("cut"))
    return one.withColumn("cut", F.lit(False)).unionByName(many)


def scores(slots: list[list[tuple[str, float, float]]], name: list[tuple[str, float]]) -> tuple[float, float, float]:
    """Soft TF-IDF cosine of a value and a name, the name's share that is there, the value's share that is left over."""
    free = list(range(len(slots)))
    dot = held = 0.0
    for word, weight in name:
        best, at = 0.0, -1
        for i in free:
            for w, sim, _ in slots[i]:
                if w == word and sim > best:
                    best, at = sim, i
        if at >= 0:
            free.remove(at)
            dot += weight * weight * best
            held += weight * best
    own = [min(w for _, _, w in s) ** 2 for s in slots]
    left = sum(own[i] for i in free)
    used = sum(w * w for word, w in name)
    explained = sum(own) - left
    norm = math.sqrt(used * (explained + left)) if used and explained + left else 1.0
    return dot / norm, held / sum(w for _, w in name), left / (explained + left) if explained + left else 0.0


def _score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for at, words, sims, weights, name, name_weights in zip(*(b[c] for c in ("at", "word", "sim", "weight", "name", "name_weight")), strict=True):
            value: list[list] = [[] for _ in range(int(at[-1]) + 1)]
            for i, *said in zip(at, words, sims, weights, strict=True):
                value[i].append(said)
            out.append(scores(value, list(zip(name, name_weights, strict=True))))
        s = np.array(out, float).reshape(-1, 3)
        yield pd.DataFrame({"value": b["value"], "type_key": b["type_key"], "score": s[:, 0], "held": s[:, 1], "left": s[:, 2]})


def rank_values(values: DataFrame, canon: Canon) -> DataFrame:
    """``value, type_key, score, held, left, rank``: the entries that share a telling word with each value, best first."""
    cut = checkpoint(_each(values, "value", tokens, _TOKEN))
    both = cut.select("token", "dotted").unionByName(cut.where("whole <> token").select(F.col("whole").alias("token"), F.lit(False).alias("dotted")))
    said = checkpoint(repairs(both, canon))
    # A chunk that is a word as it stands is that word; otherwise its pieces speak for it.
    words = canon.words.select(F.col("word").alias("whole"), F.lit(True).alias("is_word"))
    whole_said = said.select(F.col("token").alias("whole"), F.col("slots").alias("whole_slots"), F.col("cut").alias("whole_cut"))
    rows = cut.join(words, "whole", "left").join(said.drop("cut"), "token", "left").join(whole_said, "whole", "left")
    rows = rows.groupBy("value", "chunk", "whole").agg(
        F.max("is_word").alias("is_word"), F.first("whole_slots").alias("whole_slots"), F.first("whole_cut").alias("cut"), F.flatten(F.collect_list("slots")).alias("pieces"),
        F.count(F.lit(1)).alias("n_pieces"), F.count("slots").alias("n_said"),
    )
    more = ~F.col("cut") | (F.size("whole_slots") > F.size("pieces"))
    use_whole = F.col("is_word") | (F.col("whole_slots").isNotNull() & (F.col("n_said") < F.col("n_pieces")) & more)
    chosen = F.when(F.coalesce(use_whole, F.lit(False)), F.col("whole_slots")).otherwise(F.col("pieces"))
    bags = rows.select("value", "chunk", chosen.alias("slots")).groupBy("value").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "slots"))), lambda s: s["slots"])).alias("slots"))
    flat = F.flatten(F.transform("slots", lambda s, i: F.transform(s, lambda x: F.struct(i.alias("at"), x["word"].alias("word"), x["sim"].alias("sim"), x["weight"].alias("weight")))))
    bags = checkpoint(bags.where(F.size("slots") > 0).select("value", flat.alias("s")).select("value", "s.at", "s.word", "s.sim", "s.weight"))
    telling = bags.select("value", F.explode("word").alias("word")).distinct()
    pairs = telling.join(canon.postings, "word").select("value", "name_id").distinct()
    names = canon.names.select("name_id", "type_key", F.col("words.word").alias("name"), F.col("words.weight").alias("name_weight"))
    scored = pairs.join(names, "name_id").join(bags, "value").drop("name_id").mapInPandas(
        _score, "value string, type_key string, score double, held double, left double"
    )
    best = scored.groupBy("value", "type_key").agg(F.max(F.struct("score", "held", (-F.col("left")).alias("left"))).alias("s"))
    order = Window.partitionBy("value").orderBy(F.desc(F.round("s.score", 9)), "type_key")
    return best.select("value", "type_key", F.col("s.score").alias("score"), F.col("s.held").alias("held"), (-F.col("s.left")).alias("left"), F.row_number().over(order).alias("rank"))


def map_values(values: DataFrame, entries: DataFrame) -> DataFrame:
    """``value, type_key`` for distinct values in the first column of ``values``; blank ones are left out."""
    given = checkpoint(values.select(F.col(values.columns[0]).alias("value")).where(filled("value")))
    ranked = rank_values(given, Canon(entries))
    of = lambda k, c: F.max(F.when(F.col("rank") == k, F.col(c)))
    two = ranked.where("rank <= 2").groupBy("value").agg(
        of(1, "type_key").alias("key"), of(1, "score").alias("a"), of(1, "held").alias("held"), of(1, "left").alias("left"), of(2, "score").alias("b")
    )
    sure: Column = (F.col("held") >= ACCEPT) & (F.col("left") <= LEFT) & (F.col("a") - F.coalesce("b", F.lit(0.0)) >= MARGIN)
    return given.join(two.where(sure).select("value", "key"), "value", "left").select("value", F.coalesce("key", F.lit(UNMATCHED)).alias("type_key"))


def map_rows(rows: DataFrame, value: str, entries: DataFrame, skip: DataFrame | None = None) -> DataFrame:
    """``rows`` with the column ``type_key``, added or replaced: the entry each value names, or ``unmatched``.

    Rows with a null or blank value, or one that is in the first column of ``skip``, are left out. Values are mapped once each. The mapping is broadcast if its size,
    which is counted first, is small; else it is joined by a shuffle in which a frequent value is split.
    A list without entries leaves everything unmatched. Neither the list nor the values have a greatest number or length.
    """
    given = rows.drop("type_key").where(filled(value))
    distinct = given.groupBy(F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    if skip is not None:
        distinct = distinct.join(skip.select(F.col(skip.columns[0]).alias("value")), "value", "left_anti")
    mapping = checkpoint(map_values(distinct, entries))
    size = mapping.agg(F.sum(F.length("value") + F.length("type_key"))).first()[0] or 0
    mapping = mapping.withColumnRenamed("value", "__value")
    if size <= BROADCAST_CHARS:
        joined = given.join(F.broadcast(mapping), F.col(value) == F.col("__value"))
    else:
        parts = 16
        salted = given.withColumn("__part", F.pmod(F.xxhash64(*given.columns), F.lit(parts)))
        many = mapping.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))))
        joined = salted.join(many, (F.col(value) == F.col("__value")) & (salted["__part"] == many["__part"])).drop("__part")
    return joined.drop("__value")


def unmatched_report(mapped: DataFrame, value: str) -> DataFrame:
    """Unmatched values and how often each occurs."""
    return mapped.where(F.col("type_key") == UNMATCHED).groupBy(F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
