import re

import pytest

from paperlake.llm import surrogates as S


def test_formats():
    for kind, value in (("phone", "+1 (743) 555-3824"), ("card", "4785 3805 9239 1139"), ("ssn", "123-45-6789"), ("ip", "192.168.20.4"),
                        ("secret", "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"), ("email", "Jo.Doe+x@mail.example.org"), ("name", "Anna Meier"), ("name", "Иван Кузнецов")):
        found = list(S.entities(f"see {value}, ok"))
        assert [(k, v) for k, _, _, v in found] == [(kind, value)]
        form = S.normal_form(kind, value)
        for attempt in (0, 5, 20):
            new = S.dress(kind, value, S.surrogate_form(kind, form, "k", attempt))
            assert new != value and [k for k, *_ in S.entities(f"see {new}, ok")][:1] == [kind]
            if kind in ("phone", "card", "secret"):
                assert re.sub(r"\d", "0", new) == re.sub(r"\d", "0", value) or kind == "secret" and len(new) == len(value)
    assert S.luhn_ok(S.surrogate_form("card", "4539578763621486", "k", 0)) and not S.luhn_ok(S.surrogate_form("card", "4539578763621487", "k", 0))
    assert S.surrogate_form("phone", "+17435553824", "k", 0).startswith("+1")
    first = S.surrogate_form("name", "Maria", "k", 0)
    assert first in S.FIRST_NAMES["latin", "f"] and S.surrogate_form("name", "Сергей", "k", 0) in S.FIRST_NAMES["cyrillic", "m"]
    both = [(k, v) for k, _, _, v in S.entities("+1 (826) 555-4081 190.137.223.204 or TOKEN = 9233A8ECF7C5B09FE5949719B6B82BC439E9329B!!")]
    assert both == [("phone", "+1 (826) 555-4081"), ("ip", "190.137.223.204"), ("secret", "9233A8ECF7C5B09FE5949719B6B82BC439E9329B")]
    assert not list(S.entities("Annas Peterson 12 345 a1b2c3 1.2.3 v1.2.3.4.5"))


def test_same_entity_same_surrogate(spark):
    rows = [(1, "mail a.b@c.org or A.B@C.ORG"), (2, "a.b@c.org"), (3, "call +1 (743) 555-3824"), (4, "call +1-743-555-3824 now"), (5, "Peter Novak met Anna\nPeter Novak")]
    got = {r["doc_id"]: r for r in S.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    mail = got[2]["text"]
    assert got[1]["text"] == f"mail {mail} or {mail.upper()}" and "c.org" not in mail
    digits = [re.sub(r"\D", "", got[i]["text"]) for i in (3, 4)]
    assert digits[0] == digits[1] != "17435553824" and got[4]["text"].endswith(" now") and got[3]["n_entities"] == 1
    a, b = got[5]["text"].split("\n")
    assert a.startswith(b + " met ") and got[5]["n_distinct"] == 2
    other = S.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), key="another").filter("doc_id = 2").first()["text"]
    assert other != mail


def test_collisions_are_resolved(spark):
    """More first names than surrogates for a first attempt, and secrets that are surrogates of others."""
    names = [(k, n) for kind in S.FIRST_NAMES for n in S.FIRST_NAMES[kind] for k in ["name"]]
    taken = S.surrogate_form("ip", "9.9.9.9", S.KEY, 0)
    found = spark.createDataFrame([*names, ("ip", "9.9.9.9"), ("ip", taken)], "kind string, form string")
    rows = S.assign(found).collect()
    forms = {(r["kind"], r["form"]) for r in rows}
    assert len(rows) == len(forms) == len(names) + 2
    assert len({(r["kind"], r["surrogate"]) for r in rows}) == len(rows)
    assert not {(r["kind"], r["surrogate"]) for r in rows} & forms


def test_odd_documents(spark, odd_documents, no_documents):
    rows = S.pseudonymise(odd_documents).collect()
    before = sorted((r["doc_id"] or 0, r["text"] or "") for r in odd_documents.collect())
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in rows) == before
    assert sum(r["text"] is None for r in rows) == 2 and S.pseudonymise(no_documents).count() == 0


def test_more_entities_than_free_forms(spark, monkeypatch):
    """Seven of the ten one-digit forms are taken: they become surrogates of each other, and with twelve there is an end."""
    monkeypatch.setattr(S, "surrogate_form", lambda kind, form, key, attempt: str(S.Draw(key, kind, form, attempt).below(10)))
    monkeypatch.setattr(S, "STRICT", 3)
    monkeypatch.setattr(S, "ATTEMPTS", 6)
    with pytest.raises(ValueError, match="no free surrogates left for entities of kind phone"):
        S.assign(spark.createDataFrame([("phone", str(i)) for i in range(12)], "kind string, form string"))
    monkeypatch.setattr(S, "ATTEMPTS", 60)
    given = S.assign(spark.createDataFrame([("phone", str(i)) for i in range(7)], "kind string, form string")).collect()
    assert len({r["surrogate"] for r in given}) == 7 == len(given)


def test_entities_of_rows_without_id_and_copies(spark):
    rows = [(None, "mail a.b@c.org"), (None, "mail a.b@c.org"), (1, None), (1, "mail a.b@c.org and 190.137.223.204"), (1, "plain"), (2, "")]
    got = S.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' k", "1 h", "2 doc")).collect()
    mails = {w for r in got for w in (r["text"] or "").split() if "@" in w}
    assert len(got) == 6 and len(mails) == 1 and "a.b@c.org" not in mails
    assert sorted((r["doc_id"] or 0, r["n_entities"]) for r in got) == [(0, 1), (0, 1), (1, 0), (1, 0), (1, 2), (2, 0)]
