from types import SimpleNamespace as Some

import pytest

from pairloom.llm import confusables


def test_p6_altered_cells(spark):
    rows = [("a", "Karvio Express"), ("b", "\u041aarvio Express"), ("c", "Zef\u200bir Mart"), ("d", "Раза Кими"), ("e", "Crèmerie"), ("f", "एसएस"), ("g", None)]
    cells = confusables.confusable_forms(spark.createDataFrame(rows, "id string, name string"), ["id"], ["name"])
    got = confusables.altered_cells(cells, ["id"]).select("id", "against")
    assert sorted(map(tuple, got.collect())) == [("b", "writing"), ("c", "prototype")]


def test_p6_published_table(spark):
    texts = ["Ⅳ Seasons", "\u0261rand Hotel", "\u13aacme", "\u212ecorp", "\u1d00cme", "\u15eaelta", "Ａcme"]
    same = ["IV Seasons", "grand Hotel", "Acme", "ecorp", "acme", "Delta", "Acme"]
    rows = [(f"x{i}", t) for i, t in enumerate(texts)] + [(f"y{i}", t) for i, t in enumerate(same)] + [("z", "ДОМ"), ("tr", "Kadıköy"), ("e", "")]
    cells = confusables.confusable_forms(spark.createDataFrame(rows, "id string, name string"), ["id"], ["name"]).cache()
    got = {r["id"]: r for r in cells.collect()}
    assert [got[f"x{i}"]["form"] for i in range(len(texts))] == same
    assert {k for k, r in got.items() if r["altered"]} == {f"x{i}" for i in range(len(texts))}
    assert all(got[f"x{i}"]["skeleton"] == got[f"y{i}"]["skeleton"] for i in range(len(texts)))


def test_p6_table_that_cannot_be_read_is_an_error():
    class Checker:
        def Builder(self):
            return self

        def build(self):
            return self

        def getSkeleton(self, text):
            return "a\nb"

    jvm = lambda c: Some(com=Some(ibm=Some(icu=Some(text=c))))
    for fake in (Some(_jvm=jvm(Some())), Some(_jvm=jvm(Some(SpoofChecker=Checker())))):
        with pytest.raises(RuntimeError, match="table of look-alikes"):
            confusables.published_prototypes(fake)


def test_p6_is_registered():
    import __spark_entry__

    assert "p6_found" in __spark_entry__.queries()
