import pytest

from spindrel.llm import canonical

LIST = [
    ("Quinstraar_Interneuron", "Quinstraar Interneuron", ["QuiI", "ravebbal unit"], None),
    ("Quinstraar_Interneuron_Type_1", "Quinstraar Interneuron Type 1", ["QuiI1", "ravebbal unit type 1"], "Quinstraar_Interneuron"),
    ("Quinstraar_Interneuron_Type_2", "Quinstraar Interneuron Type 2", ["QuiI2"], "Quinstraar_Interneuron"),
    ("Martriin_Epithelial_Cell", "Martriin Epithelial Cell", ["MartEC"], None),
    ("Martriin_Epithelial_Cell_Alpha", "Martriin Epithelial Cell Alpha", ["MarEC-a"], "Martriin_Epithelial_Cell"),
    ("Martriin_Epithelial_Cell_Beta", "Martriin Epithelial Cell Beta", ["MarEC-b"], "Martriin_Epithelial_Cell"),
    ("Martrihalal_Endothelial_Cell", "Martrihalal Endothelial Cell", ["MarEC", "halhemin cell of the outer rim"], None),
    ("Dorbriex_Mural_Cell", "Dorbriex Mural Cell", ["DorMC"], None),
    ("ON_Dorbriex_Mural_Cell", "ON Dorbriex Mural Cell", ["OnDorMC"], "Dorbriex_Mural_Cell"),
    ("OFF_Dorbriex_Mural_Cell", "OFF Dorbriex Mural Cell", ["OffDorMC"], "Dorbriex_Mural_Cell"),
    ("Simflial_Glia", "Simflial Glia", ["SimG"], None),
    ("Hemnodar_Glia", "Hemnodar Glia", ["HemG"], None),
    ("Calyanine_Epithelial_Cell", "Calyanine Epithelial Cell", None, None),
    ("Nodsimex_Endothelial_Cell", "Nodsimex Endothelial Cell", [], None),
    ("Zivulent_Mural_Cell", "Zivulent Mural Cell", ["ZivMC"], None),
    ("Hemtepulent_Interneuron", "Hemtepulent Interneuron", ["HemI"], None),
]
CASES = {
    "quinstraar interneuron": "Quinstraar_Interneuron", "QUINSTRAAR_INTERNEURON_TYPE_2": "Quinstraar_Interneuron_Type_2",
    "Interneuron, quinstrar type II": "Quinstraar_Interneuron_Type_2", "quinstraar interneurons (1)": "Quinstraar_Interneuron_Type_1",
    "QuinstraarInterneuronType1": "Quinstraar_Interneuron_Type_1", "quinstraar.intern. T2": "Quinstraar_Interneuron_Type_2",
    "QuiI2?": "Quinstraar_Interneuron_Type_2", "cl. 19: QuiI": "Quinstraar_Interneuron", "ravebbal unit subtype 1": "Quinstraar_Interneuron_Type_1",
    "Μartriin epithelial cell β": "Martriin_Epithelial_Cell_Beta", "MartriinEpithelialCellΑ": "Martriin_Epithelial_Cell_Alpha",
    "mаrtriin еpithelial cell": "Martriin_Epithelial_Cell", "MarEC-b": "Martriin_Epithelial_Cell_Beta", "MarEC cells": "Martrihalal_Endothelial_Cell",
    "stressed martriin epith. cell (Turvg73+)": "Martriin_Epithelial_Cell", "Ｍａｒｔｒｉｉｎ \u200bEpithelial Cell": "Martriin_Epithelial_Cell",
    "cell of the outer rim (halhemin)": "Martrihalal_Endothelial_Cell", "dorbriex mural cell (OFF)": "OFF_Dorbriex_Mural_Cell",
    "OnDorMC c8": "ON_Dorbriex_Mural_Cell", "d0rbriex mural cells [adult]": "Dorbriex_Mural_Cell", "SIMFLIALGLIA": "Simflial_Glia",
    "sirnflial glia - good quality": "Simflial_Glia", "Simflial Glia (n.b. check)": "Simflial_Glia",
    "QUINSTRAARINTERNEURONT2": "Quinstraar_Interneuron_Type_2", "QuinstraarInterneuronType1C34": "Quinstraar_Interneuron_Type_1",
    "MartriinEpithelialCellΒC23": "Martriin_Epithelial_Cell_Beta", "MARTRIINEPITH.CELLALPHA": "Martriin_Epithelial_Cell_Alpha",
    "MartriinEpithelialCellC9": "Martriin_Epithelial_Cell", "quinstraar interneuron type 3": "unmatched", "korravent interneuron": "unmatched", "unknown": "unmatched", "leiden 4": "unmatched",
    "BRID79+ cells": "unmatched", "simflial glia / hemnodar glia": "unmatched", "mix of simflial glia and korravent phagocyte": "unmatched",
    "simflial glia + korravent mural cell doublet": "unmatched", "martriin epithelial cell alpha or beta?": "unmatched", "??": "unmatched",
}


TYPES = "type_key string, display_name string, synonyms array<string>, parent string"


def mapped(spark, values, entries):
    given = spark.createDataFrame([(v,) for v in dict.fromkeys(values)], "v string")
    return {r["value"]: r["type_key"] for r in canonical.map_values(given, spark.createDataFrame(entries, TYPES)).collect()}


def test_values(spark):
    got = mapped(spark, CASES, LIST)
    assert {v: got[v] for v in CASES if got[v] != CASES[v]} == {}


def test_names_match_themselves(spark):
    names = [(key, n) for key, display, synonyms, _ in LIST for n in [key, display, *(synonyms or [])]]
    got = mapped(spark, [n for _, n in names], LIST)
    assert all(got[n] == key for key, n in names)


# Lists of cities and jobs, in which every word belongs to several entries or is short.
PLAIN = ["Alpha Glia", "Retinal Glia", "Retinal Neuron", "Cortical Neuron", "Data Engineer", "Data Scientist", "Software Engineer", "New York", "Boston Office"]
PLAIN_CASES = {
    "retnal glia": "Retinal Glia", "retinal nueron": "Retinal Neuron", "Data Enginer": "Data Engineer", "engineer data": "Data Engineer", "New Yrok": "New York",
    "senior software enginer (berlin)": "Software Engineer", "BOSTONOFFICE": "Boston Office", "Data": "unmatched", "glia neuron": "unmatched",
    "New York / Boston Office": "unmatched", "Cortical Glia": "unmatched", "carpenter": "unmatched",
}


def test_plain_lists(spark):
    got = mapped(spark, PLAIN_CASES, [(n, None, None, None) for n in PLAIN])
    assert got == PLAIN_CASES


def test_tokens():
    read = lambda v: [t for _, _, t, _ in canonical.tokens(v)]
    assert read("Type-II cell (3), cluster 13 T2") == ["type2", "cell", "type3", "cluster13", "type2"]
    assert read("OFFNewYorkC9 n.b.") == ["off", "new", "york", "c9"] and read("") == [] and read("12 monkeys") == ["12", "monkeys"]
    assert canonical._cut("onnewyorkofthe", ["on", "new", "york", "of", "the"]) == ["on", "new", "york", "of", "the"]


def test_scores():
    name = [("retinal", 2.0), ("glia", 1.0)]
    assert canonical.scores([[("retinal", 1.0, 2.0)], [("glia", 1.0, 1.0)]], name) == pytest.approx((1.0, 1.0, 0.0))
    score, held, left = canonical.scores([[("retinal", 0.8, 2.0)], [("york", 1.0, 2.0)]], name)
    assert score == pytest.approx(3.2 / (5 * 8) ** 0.5) and held == pytest.approx(1.6 / 3) and left == pytest.approx(0.5)


def test_distance():
    assert canonical.distance("abcd", "abdc", 2) == 1 and canonical.distance("abc", "xyz", 2) == 3 and canonical.distance("", "ab", 2) == 2


@pytest.mark.parametrize("bound", [16_000_000, 0])
def test_rows(spark, monkeypatch, bound):
    monkeypatch.setattr(canonical, "BROADCAST_CHARS", bound)
    values = [*CASES, None, "", "\t", "x" * 50_000, "quinstraar interneuron"]
    rows = spark.createDataFrame([(i, v, "old", 0) for i, v in enumerate(values)], "row_id int, v string, type_key string, value int")
    types = spark.createDataFrame(LIST, "type_key string, display_name string, synonyms array<string>, parent string")
    out = {r["row_id"]: r["type_key"] for r in canonical.map_rows(rows, "v", types).collect()}
    assert out == {i: CASES.get(v, "unmatched") for i, v in enumerate(values) if v and v.strip()}
    assert set(r["type_key"] for r in canonical.map_rows(rows, "v", types.limit(0)).collect()) == {"unmatched"}
    assert canonical.map_rows(rows.limit(0), "v", types).count() == 0
    some = canonical.map_rows(rows, "v", types, types.select("display_name"))
    assert some.count() == len(out) - sum(v in {e[1] for e in LIST} for v in values)
