"""License scans and personal data against plain regular expressions."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from pagemill.llm import licenses, pii

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
ODD = [None, "", "1 " * 20_000, "a.b@" + "c." * 20_000 + "d", "9" * 30_000, "4111 1111 1111 1111 +49 170 1234567", "a@b.c@d.e", "a@b.c_d@e.f 256.1.1.1 1.2.3.4.5.6.7.8"]


def luhn(digits):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain_base(text):
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append(("phone", *m.span()))
    return found


def test_personal_data_base_spans(spark):
    rng = random.Random(3)
    parts = [*"a1.@-_+ 2345(9)\né😀", "4333317852687140", "1.2.3.4", "a@b.co"]
    texts = ODD + ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(800)]
    rows = [(i, t, 0) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in pii.digest(pii.find(spark.createDataFrame(rows, "doc_id long, text string, base int"))).collect()}
    for i, text, _ in rows:
        spans = plain_base(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert got[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in spans) for k in pii.KINDS]
        everything = got[i].spans.split(",") if got[i].spans else []
        assert set(joined.split(",")) - {""} <= set(everything)
        order = [(pii.KINDS.index(k), int(a), int(b)) for k, a, b in (s.split(":") for s in everything)]
        assert order == sorted(order)


def test_cards_with_a_joint_between_all_digits(spark):
    """Fully spaced and fully hyphenated cards, in texts without two adjacent digits."""
    cards = ["4111111111111111", "4539578763621486", "4222222222222", "4111111111111112"]
    texts = [f"pay {joint.join(card)} now" for card in cards for joint in " -"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.digest(pii.find(docs)).collect()}
    for i, text in enumerate(texts):
        spans = plain_base(text)
        assert got[i].n_card == len(spans) == (i < 6)
        assert got[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


@pytest.mark.parametrize("text", ["4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "4.1.1.1.1.1.1.1.1.1.1.1", "4-1-1-1-1-1-1-1-1-1-1-1-1", "(1 2 3 4 5", "1 2 3 4 5 6"])
def test_hints_are_implied_by_their_patterns(column, text):
    for rule in pii.RULES:
        (matches,) = column(lambda c: F.regexp_extract_all(rule.prepare(c), F.lit(rule.pattern), F.lit(0)), [text])
        (hinted,) = column(lambda c: c.rlike(rule.hint), [text])
        assert hinted or not matches


def test_personal_data_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, "x@y.zz"), (1, "x@y.zz"), (None, "x@y.zz"), (2, None)], "doc_id long, text string")
    rows = pii.digest(pii.find(docs)).collect()
    assert sorted((r.doc_id or 0, r.spans) for r in rows) == [(0, "email:0:6"), (1, "email:0:6"), (1, "email:0:6"), (2, "")]
    assert pii.digest(pii.find(docs.limit(0))).count() == 0


def test_trees_add_spans_that_look_like_finds(spark):
    """Cards and numbers of the same form, most of them cards: the rest is found as well."""
    rows = [(i, f"pay by card 4539578763621{486 if i % 40 else 468} today or write to m{i}@example.org.") for i in range(600)]
    rows += [(1000 + i, f"serial {i:013d}{i:04d} of lot 12.{i}") for i in range(300)]
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    added = {r.doc_id for r in found if any(not s.base for s in r.spans)}
    assert added and added <= {i for i in range(0, 600, 40)}


def test_a_rare_kind_is_learned_beside_a_dominant_one(spark):
    """Phone-like spans fill a sample of all; cards of the form of finds are added still."""
    rows = [(i, 1, "phone", 0, 16, i % 2 == 0, "+49 170 1234567" if i % 2 == 0 else "12-34-56", "", False) for i in range(4000)]
    rows += [(5000 + i, 1, "card", 0, 16, i >= 2, "4539578763621486", "card ", False) for i in range(80)]
    spans = spark.createDataFrame(rows, "doc_id long, _key long, kind string, start long, end long, base boolean, span string, before string, touches boolean")
    added = pii.selected(spans, rows=80).collect()
    assert sorted(r.doc_id for r in added) == [5000, 5001] and {r.kind for r in added} == {"card"}


def test_disguised_personal_data_is_found(spark):
    """Planted disguises of all kinds among finds, decoys and prose: all of the first are added
    where they stand, none of the others."""
    rng = random.Random(11)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card():
        body = "4" + digits(14)
        return next(body + d for d in "0123456789" if luhn(body + d))

    def hidden(i):
        four = card()
        return [f"u{i}.{digits(2)} (at) mail{i}.example.com", f"u{i}.x[at]host{i}.org", f"({digits(3)}) 555-{digits(4)}", ".".join(four[k : k + 4] for k in (0, 4, 8, 12))][i % 4]

    rows, planted = [], {}
    for i in range(400):
        shown = [f"w.{digits(2)}@mail{i}.example.com", f"+1 ({digits(3)}) 555-{digits(4)}", card(), f"10.{i % 250}.3.7"]
        rows.append((i, f"the words of {shown[i % 4]} and more of it, {shown[(i + 1) % 4]} at last"))
    for i in range(400, 480):
        span = hidden(i)
        text = f"the words of {span} and more of it"
        rows.append((i, text))
        planted[i] = (text.index(span), text.index(span) + len(span))
    decoys = ["token = a{0}f{1}b", "look (at) this", "lot 7{1}", "part {0}{0}", "on 2024-01-02 at 10.5", "a [at] b"]
    rows += [(1000 + i, rng.choice(decoys).format(digits(9), digits(3))) for i in range(300)]
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    added = {(r.doc_id, s.start, s.end) for r in found for s in r.spans if not s.base}
    wanted = {(i, a, b) for i, (a, b) in planted.items()}
    assert added == wanted


@pytest.fixture(scope="module")
def scanned(spark):
    texts = [None, "", "CC-BY cc by", "xcc by ccc-by cc, by", "All Rights\nReserved", "gnu General  public-license é all rights", "c " * 30_000 + "cc by"]
    texts += ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "released under MIT the license ok", "released under the\nMIT license"]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, label int")
    return texts, {r.doc_id: r for r in licenses.digest(licenses.scan(docs)).collect()}


def test_license_places(scanned):
    texts, got = scanned
    for i, text in enumerate(texts):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        places = [(k, label) for p, label in licenses.PHRASES for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        at = [k for k, _ in places]
        row = got[i]
        assert (row.n_words, row.n_base, row.first_word, row.last_word) == (len(w), len(places), min(at, default=None), max(at, default=None))
        assert row.base_labels == ",".join(sorted({label for _, label in places}))


def test_notices_are_found_by_their_share_of_words(scanned):
    _, got = scanned
    assert (got[7].labels, got[7].score) == ("mit", 1.0)
    assert (got[8].labels, got[8].score) == ("mit", 1.0)
    assert (got[9].labels, got[9].score) == ("mit", 1.0)


def plain_notices(text):
    """Labels and best share by trying every run of adjacent words."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER))
    labels, best = set(), 0.0
    for notice, label in licenses.NOTICES:
        ws = re.findall("[a-z0-9]+", notice.lower())
        room = -(-3 * len(ws) // 2)
        for k in range(len(w)):
            held = len(set(w[k : k + room]) & set(ws))
            if 5 * held >= 4 * len(set(ws)):
                labels.add(label)
                best = max(best, held / len(set(ws)))
    return ",".join(sorted(labels)), best


def test_notices_wrapped_over_lines(spark):
    rng = random.Random(5)
    texts = [
        "/* Redistribution and use in source and binary forms, with or without\n * modification, are permitted */",
        "# Permission is hereby granted,\n# free of charge, to any\n# person obtaining a copy\n# of this software",
        "released " + "x " * 9 + "under the license",
        "released under the album " * 5_000,
    ]
    for notice, _ in licenses.NOTICES:
        words = notice.split()
        texts.append("\n".join(words))
        for _ in range(25):
            noisy = [w for w in words if rng.random() > 0.12]
            for _ in range(rng.randrange(12)):
                noisy.insert(rng.randrange(len(noisy) + 1), rng.choice(["the", "of", "x1", "und", rng.choice(words)]))
            texts.append(rng.choice([" ", "\n", ", "]).join(["the", "of", "this"] * rng.randrange(9) + noisy + ["and", "is"] * rng.randrange(9)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(docs, phrases=[("no such phrase", "none")]).collect()}
    assert got[0].notices == ["bsd"] and got[1].notices == ["mit"] and got[2].notices == []
    for i, text in enumerate(texts):
        assert (",".join(got[i].notices), got[i].score) == plain_notices(text), text


def test_license_scan_without_notices(spark):
    docs = spark.createDataFrame([(1, "cc by", 2, 3), (2, "released under the MIT license", 4, 5)], "doc_id long, text string, hits int, notices int")
    rows = licenses.digest(licenses.scan(docs, notices=())).collect()
    assert sorted((r.doc_id, r.labels, r.score) for r in rows) == [(1, "cc-by", 1.0), (2, "", 0.0)]


def test_license_scan_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, "cc by"), (1, "cc by"), (None, "cc by")], "doc_id long, text string")
    assert [r.n_base for r in licenses.digest(licenses.scan(docs)).collect()] == [1, 1, 1]
    assert licenses.scan(docs.limit(0)).count() == 0
