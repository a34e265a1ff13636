from __future__ import annotations

import random
import re

import pytest

from cartmill.llm import pii


def luhn(digits):
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def brute(text):
    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    out = [(*m.span(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        out += [(*m.span(), "ip")] if all(int(p) <= 255 for p in m[0].split(".")) else []
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        out += [(*m.span(), "card")] if 12 <= len(digits(m)) <= 19 and luhn(digits(m)) else []
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        out += [(*m.span(), "phone")] if 9 <= len(digits(m)) <= 15 else []
    return pii.in_order(out)


@pytest.mark.parametrize("alphabet", ["ab@@..-+ 0123456789%é()", "01234567890123456789. -+"])
def test_base_equals_regular_expressions(alphabet):
    rng = random.Random(len(alphabet))
    for _ in range(4000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 70)))
        assert pii.base_spans(text) == brute(text), text


def test_long_runs_are_linear():
    for run in ("a", "1", "1.", "a@", "+1 ", "1-"):
        pii.base_spans(run * 200_000)


WORDS = ["music", "rivers", "stones", "paper", "winter"]


def contexts(n):
    """A telling name next to one address in n different contexts, and a name that stands everywhere."""
    rows = [(i, f"{WORDS[i]} from Zorblax Smith about {WORDS[i]}: zb@mail.org thanks") for i in range(n)]
    return rows + [(100 + i, "Smith wrote to nobody in particular about " + WORDS[i % 5] + " from here, thanks") for i in range(40)]


def test_disclosing_terms(docs):
    found = {(r["value"], r["term"]) for r in pii.disclosing_terms(docs(contexts(5))).collect()}
    assert ("email:zb@mail.org", "zorblax") in found
    assert not {t for _, t in found} & {"smith", "thanks", "about", "from", *WORDS}
    # by hand: N = 45, n(c) = n(t) = n(t, c) = 5, so PMI equals IC
    scores = {r["term"]: r["disclosure"] for r in pii.disclosing_terms(docs(contexts(5))).collect()}
    assert scores["zorblax"] == pytest.approx(1.0)


def test_copies_are_one_context(docs):
    rows = [(i, "private words Zorblax about: zb@mail.org thanks") for i in range(50)]
    assert pii.disclosing_terms(docs(rows + contexts(2))).count() == 0


def test_terms_of_whole_texts(docs):
    """A name far from the address convicts in two texts and is marked all over them; near copies do not."""
    far = " " * 3000 + " ".join(f"plain{'abcdefghijkl'[j]}" for j in range(12)) + " " * 3000
    plain = [(50 + i, f"{WORDS[i % 5]} {far} {WORDS[i % 3]}") for i in range(30)]
    rows = [(i, f"{WORDS[i]} Zorblax {WORDS[i]} lives {far} {WORDS[i + 1]} zb@mail.org {WORDS[i]} Zorblax") for i in range(2)]
    found = {(r["value"], r["term"]) for r in pii.disclosing_terms(docs(rows + plain)).collect()}
    assert ("email:zb@mail.org", "zorblax") in found and not {t for _, t in found} & {"plaina", *WORDS}
    texts = {r["doc_id"]: r["text"] for r in pii.sanitise(docs(rows + plain)).collect()}
    assert all(texts[i].count("<TERM>") >= 2 and "Zorblax" not in texts[i] for i in range(2))
    assert all(texts[i] == t for i, t in plain)
    copies = [(i, f"Zorblax rare words of one text {far} about {WORDS[i]}: zb@mail.org") for i in range(2)]
    assert pii.disclosing_terms(docs(copies + plain)).filter("term IN ('zorblax', 'rare')").count() == 0


def test_context_beyond_white_space():
    (_, near), (_, other) = (
        next(pii.value_contexts(t, pii.base_spans(t), 6)) for t in ("call Anna" + " " * n + "a@b.org" for n in (1, 5000))
    )
    assert near == other != pii._mark([])


def test_spans_and_sanitised_text(docs):
    rows = contexts(5) + [(200, None), (201, ""), (None, "call +1 555 123 4567"), (3, contexts(5)[3][1])]
    got = pii.personal_data(docs(rows)).collect()
    assert len(got) == len(rows)
    spans = {r["doc_id"]: [(s["kind"], s["start"]) for s in r["spans"]] for r in got}
    assert [k for k, _ in spans[3]] == ["term", "email"] and spans[200] == spans[201] == [] and spans[None] == [("phone", 5)]
    clean = pii.sanitise(docs(rows))
    assert clean.columns == docs([]).columns and clean.count() == len(rows)
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert texts[3] == "paper from <TERM> Smith about paper: <EMAIL> thanks"
    assert (texts[200], texts[201], texts[None]) == (None, "", "call <PHONE>")
    assert pii.replace_spans("abcdef", [(0, 3, "card"), (2, 5, "ip")]) == "<CARD>f"


def test_empty_table(docs):
    assert pii.personal_data(docs([])).count() == 0 and pii.sanitise(docs([])).count() == 0
