import random

import pytest

from spindrel.llm import prose

COMMON = "the of and to in a was that we from for with is it were by on not as at than which had be or this der die und in den wir von das mit la de el que en y le les des et un une 的 了 是 在 有 和 不 我 们 这 中".split()
EN = "We found that the share of the cells in the second batch was lower than in the first one, which had been stored for a week before it was cut. "
DE = "Wir haben die Proben aus dem Gewebe untersucht und dabei vor allem Zellen gefunden, die in den ersten Tagen nach der Messung verschwunden waren. "
ZH = "我们检查了这些样本，发现其中大多是同一类细胞，这与第一次的结果一致。"


@pytest.fixture(scope="module")
def statistics():
    return prose.Statistics(COMMON)


def share(statistics, *texts):
    return statistics.of(list(texts))["prose_share"].tolist()


def test_prose_is_prose_however_laid_out(statistics):
    wrapped = "\n".join(" ".join(EN.split()[i : i + 4]) for i in range(0, len(EN.split()), 4))
    given = [EN, EN.upper(), EN.lower().replace(",", "").replace(".", ""), wrapped, "> " + wrapped.replace("\n", "\n> "), f"<p>{EN}</p>", DE, ZH * 2, "\n".join([f"- {EN}"] * 4)]
    assert min(share(statistics, *given)) > 0.8


def test_junk_is_not(statistics):
    rng = random.Random(1)
    table = "\n".join(f"| G{i} | type {i} | 0.{i} | {i * 7} |" for i in range(20))
    log = "\n".join(f"2024-01-{i:02d} 10:0{i % 10}:00 INFO step0{i % 9} kept {i * 31} cells in {i}.5s" for i in range(1, 25))
    soup = " ".join(rng.choice(COMMON[:25]) for _ in range(80))
    noise = " ".join("".join(rng.choice("bcdfghjklmn") for _ in range(7)) for _ in range(60)) + "."
    config = "\n".join(f"{'  ' * (i % 3)}key_{i}: {rng.choice(['true', 'null', '[]'])}" for i in range(30))
    menu = "\n".join(rng.choice(["Home", "Sign in", "Help", "Back to top", "Search"]) for _ in range(40))
    items = "\n".join(f"- GENE{i} (on some cell)" for i in range(20))
    refs = "\n".join(f"[{i}] Ardbske B., Lo A. J. Cell Maps {i}(2): 25-1772, 2018." for i in range(12))
    assert max(share(statistics, table, log, soup, noise, config, menu, items, refs, "样本：无\n组织\t87\n" * 9)) < 0.3


LOW = "We tested all samples twice. Results matched earlier reports. Several groups observed similar patterns. Their findings support wider testing. Researchers expect further progress soon."
PL = "Dzisiaj rano poszliśmy do lasu, żeby zebrać grzyby. Było bardzo zimno, ale słońce świeciło mocno. Po kilku godzinach wróciliśmy do domu z pełnymi koszami."
RU = "Сегодня утром мы пошли в лес собирать грибы. Было очень холодно, но солнце светило ярко. Через несколько часов мы вернулись домой с полными корзинами."


def test_sentences_without_listed_words(statistics):
    wrapped = "\n".join(" ".join(PL.split()[i : i + 5]) for i in range(0, 25, 5))
    assert min(share(statistics, LOW, PL, RU, wrapped)) > 0.8
    assert min(share(prose.Statistics([]), LOW, PL, RU)) > 0.8


def test_layout_speaks_against_sentences(statistics):
    words = [w.strip(".,") for w in (PL + " " + LOW + " " + RU).split()]
    cells = lambda sep: "\n".join(sep.join(words[i : i + 4]) + "." for i in range(0, 64, 4))
    lines = [" ".join(words[i : i + 6]) + "." for i in range(0, 66, 6)]
    periodic = "\n".join(("    " if i % 3 else "") + x for i, x in enumerate(lines))
    assert share(statistics, "\n".join(lines))[0] > 0.8
    assert max(share(statistics, cells(" | "), cells("\t"), periodic)) < 0.5
    assert statistics.of([periodic]).iloc[0]["indent_period"] == 3
    rising = "\n".join(sorted(lines, key=len)) + "\n" + "\n".join(sorted(lines[:3] * 2, key=len))
    assert statistics.of([rising]).iloc[0]["line_autocorrelation"] > 0.3


def test_long_texts_keep_their_period(statistics):
    text = "".join("key:\n  a: 1\n  b: 2\n" for _ in range(70_000))
    row = statistics.of([text]).iloc[0]
    assert row["indent_period"] == 3 and row["n_lines"] == 210_000 and len(text) > prose.SLICE


def test_mixtures_get_their_share(statistics):
    table = "\n".join(f"{i}\tG{i}\t0.{i}\t{i * 7}" for i in range(60))
    low, high = share(statistics, EN + "\n\n" + table, EN * 9 + "\n\n" + table)
    assert low < 0.5 < high


def test_statistics(statistics):
    row = statistics.of(["One two, three.\n\n- item\n- item\n"]).iloc[0]
    assert row["n_words"] == 5 and row["n_lines"] == 3 and row["n_chars"] == 23
    assert row["line_end_punctuation"] == pytest.approx(1 / 3) and row["list_line_share"] == pytest.approx(2 / 3)
    assert row["mean_word_length"] == pytest.approx(19 / 5) and row["symbol_ratio"] == pytest.approx(4 / 23)
    yaml = statistics.of(["a:\n  b: 1\n  c: 2\n" * 6]).iloc[0]
    assert yaml["indent_period"] == 3
    assert statistics.of(["| a | b |\n" * 5]).iloc[0][["delimiter_alignment", "line_autocorrelation"]].tolist() == [1.0, 1.0]


def test_texts_do_not_touch_each_other(statistics):
    rng = random.Random(3)
    texts = [rng.choice([EN, DE, ZH, "", " \n", "x", "1 2 3\n4 5 6\n", "\r\n", "a\r\nb", "İ" * 5, "\ud800", "漢" * 9]) * rng.randint(1, 3) for _ in range(60)]
    one = [statistics.of([t]).iloc[0].tolist() for t in texts]
    together = statistics.of(texts).values.tolist()
    same = lambda a, b: a == b or (a != a and b != b) or abs(a - b) < 1e-9
    assert all(same(a, b) for x, y in zip(one, together, strict=True) for a, b in zip(x, y, strict=True))


def test_frame(spark):
    docs = spark.createDataFrame([(1, EN, 1), (2, None, 2), (3, "  ", 3), (4, EN * 12_000, 4), (1, EN, 1)], "doc_id bigint, text string, n_words int")
    words = spark.createDataFrame([(w,) for w in COMMON], "word string")
    out = {r["doc_id"]: r for r in prose.text_statistics(docs, words).collect()}
    assert out[2]["prose_share"] is None and out[3]["n_words"] == 0 and out[1]["prose_share"] > 0.9 and out[4]["prose_share"] > 0.99
    assert prose.text_statistics(docs, words).count() == 5 and prose.text_statistics(docs.limit(0), words).count() == 0
    assert prose.text_statistics(docs, words.limit(0)).count() == 5
