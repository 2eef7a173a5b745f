import random
import re
import string

from claimloom.llm import secrets as S

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def plain(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text, re.IGNORECASE | re.ASCII) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_fixed_forms_like_a_plain_reading(small, edge):
    rng = random.Random(3)
    parts = ["token", "=", "abc", "secret", ": ", "'", '"', "AKIA", "AKIA" + "Q" * 16, "0" * 23, "0" * 24, "f", "Api_Key", "PASSWD=", "abcdef", "é", "-", "ſecret=abcdefg"]
    texts = [r.text or "" for r in small.collect()] + ["".join(rng.choice(parts) for _ in range(12)) for _ in range(3000)]
    assert all(S.base_spans(t) == plain(t) for t in texts)


def words(rng, n):
    return " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_random_strings_are_found_and_names_are_not(spark):
    rng = random.Random(8)
    key = lambda n, a: "".join(rng.choice(a) for _ in range(n))
    rows, hidden = [], {}
    for i in range(300):
        body = words(rng, 150)
        if i % 10 == 0:
            hidden[i] = key(48, string.ascii_letters + string.digits + "+/")
            body += f" é {hidden[i]}= " + words(rng, 5)
        elif i % 10 == 1:
            body += " getTheNameOfTheThing2AndTheOtherThing " + words(rng, 5)
        rows.append((i, body))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {}
    for r in S.find_secrets(docs).collect():
        for s in r.secrets:
            found.setdefault(r.doc_id, []).append(r.text[s.start : s.end])
    assert len(set(found) & set(hidden)) >= 0.9 * len(hidden)
    assert all(found[i] == [hidden[i] + "="] for i in set(found) & set(hidden))
    assert len(set(found) - set(hidden)) <= 1
    clean = {r.doc_id: r.text for r in S.redact(docs).collect()}
    assert all(hidden[i] not in clean[i] and "[SECRET]" in clean[i] for i in set(found) & set(hidden))
    assert clean[2] == dict(rows)[2]


def test_battery_scores_do_not_depend_on_length_or_alphabet():
    import numpy as np

    rng = np.random.default_rng(2)
    for _, letters in S.ALPHABETS:
        for n in (20, 64, 300):
            scores = S.battery(rng.integers(0, len(letters), (2000, n)), len(letters))
            assert 0.9 < np.median(scores) < 1.3 and np.quantile(scores, 0.99) < 3.5


def test_overlaps_and_edges(edge, nothing):
    assert S.without("0123456789", [(1, 0, 5), (3, 2, 7), (8, 1, 9)], "#") == "0#7#9"
    got = S.find_secrets(edge)
    assert got.count() == edge.count() and all(r.secrets == [] for r in got.collect())
    clean = S.redact(edge)
    assert clean.columns == edge.columns
    assert sorted(map(str, (r.text for r in clean.collect()))) == sorted(map(str, (r.text for r in edge.collect())))
    assert S.find_secrets(nothing).count() == 0 and S.redact(nothing).count() == 0


def test_strings_of_one_kind_are_judged():
    rng = random.Random(4)
    for letters in (string.ascii_lowercase, string.ascii_uppercase, string.digits):
        key = "".join(rng.choice(letters) for _ in range(40))
        assert [c[:2] for c in S.candidates(f"see {key} here", [])] == [(4, 44)]


def test_what_a_fixed_form_leaves_of_a_run_is_judged():
    rng = random.Random(5)
    access, rest = "AKIA" + "Q" * 16, "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(60))
    text = f"x {access}-{rest} y"
    base = S.base_spans(text)
    assert [(a, b) for a, b, _, _ in S.candidates(text, base)] == [(22, 83)]
    assert S.candidates(f"x {access}-short y", base[:1]) == []


def test_natural_pieces_do_not_depend_on_the_batch():
    rng = random.Random(6)
    texts = [words(rng, rng.randint(1, 200)) for _ in range(60)]
    apart = sum(S.natural_scores([t]) for t in texts)
    assert (S.natural_scores(texts) == apart).all() and apart.sum() > 0
