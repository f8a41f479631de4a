"""Spans of personal data against Python's regular expressions."""

from __future__ import annotations

import hashlib
import math
import random
import re

import regex

from tallymill.llm.catalog import QUERIES
from tallymill.llm.personal_data import PATTERNS, sanitise
from tests.llm.helpers import empty_docs, odd_docs, prose, rows

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(t - 9 * (t > 9) for t in twice) % 10 == 0


def brute(text):
    out = []
    for number, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), number, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


def base_of(row):
    return [f"{s['kind']}:{s['start']}:{s['end']}" for s in row["base"]]


def test_random_strings_of_the_patterns_characters(spark):
    draw = random.Random(4)
    texts = ["".join(draw.choice("ab.@-+_%() 0123456789é😀\n") for _ in range(draw.randrange(80))) for _ in range(600)]
    texts += [
        "a@b.c_d@e.f", "x@y", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "001.2.3.0255", "4111 1111-1111 1111", "+1 (988) 555-2485",
        "+12345678901234567", "4111111111111111 " * 40, "9" * 9000, "a" * 30000, "1 " * 8000, "é😀 +1 (988) 555-2485.",
        "12.34.56.78-9012.34.56.78@a.b-c.d", "300.1.1.1 1.1.1.1",
    ]
    docs = odd_docs(spark, list(enumerate(texts, 1000)))
    for r in sanitise(docs).collect():
        assert base_of(r) == brute(r["text"]), r["text"]
    assert rows(sanitise(empty_docs(spark))) == []


def test_query_digests(spark, small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = rows(QUERIES["op5_disclosing_terms"](spark, small))
    assert len(got) == len(texts)
    for r in got:
        want = brute(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(filter(None, r["spans"].split(",")))
        for kind in PLAIN:
            assert r[f"n_{kind}"] == sum(s.startswith(kind) for s in want)


def test_terms_that_disclose_an_entity(spark):
    """"zyzzyva" stands by one address only, "common" everywhere, "halfway" twice as often elsewhere."""
    mail = "who.me@mail.example.com"
    with_it = [(100 + i, f"{prose(i, 30)} zyzzyva common halfway {mail} {prose(i + 50, 30)}") for i in range(4)]
    half = [(200 + i, f"{prose(i + 90, 30)} halfway common") for i in range(8)]
    rest = [(300 + i, f"{prose(i + 200, 40)} common") for i in range(60)]
    copies = [(400 + i, "by copies quuxish one.time@a.example.com") for i in range(5)]
    got = {r["doc_id"]: r for r in sanitise(odd_docs(spark, [*with_it, *half, *rest, *copies])).collect() if r["doc_id"]}
    for i, text in with_it:
        found = {(text[s["start"] : s["end"]], s["kind"]) for s in got[i]["spans"]}
        assert ("zyzzyva", "term") in found and (mail, "email") in found
        assert ("halfway", "general") in found and not any(w == "common" for w, _ in found)
        assert "[EMAIL]" in got[i]["sanitised"] and "[TERM]" in got[i]["sanitised"] and "ha*" in got[i]["sanitised"]
        assert mail not in got[i]["sanitised"] and "zyzzyva" not in got[i]["sanitised"]
    assert all(got[i]["sanitised"] == t for i, t in [*half, *rest])
    # Copies of one text are one witness.
    assert {s["kind"] for s in got[400]["spans"]} == {"email"}


def test_terms_far_away_short_or_of_two_texts(spark):
    """A term counts wherever its text holds the entity, whatever its length, from two texts on."""
    far = [(100 + i, f"zyzzyva li {prose(i, 60)} {prose(i + 20, 60)} far.off@a.example.com") for i in range(3)]
    two = [(200 + i, f"quuxish {prose(i + 40, 60)} only.two@b.example.com") for i in range(2)]
    rest = [(300 + i, prose(i + 100, 60)) for i in range(300)]
    got = {r["doc_id"]: r for r in sanitise(odd_docs(spark, [*far, *two, *rest])).collect() if r["doc_id"]}
    for i, text in [*far, *two]:
        found = {text[s["start"] : s["end"]] for s in got[i]["spans"] if s["kind"] == "term"}
        assert found == ({"zyzzyva", "li"} if i < 200 else {"quuxish"})
    assert all(got[i]["sanitised"] == t for i, t in rest)


def brute_terms(texts, generalise=0.5, remove=0.8, doubt=0.05):
    """text -> (removed, generalised) terms, by looking at every pair of an entity and a term."""
    texts = sorted({t or "" for t in texts})
    held, plain, n_t = {}, {}, {}
    for text in texts:
        entities = set()
        for span in brute(text):
            kind, begin, end = span.split(":")
            value = text[int(begin) : int(end)].lower()
            entities.add((kind, re.sub("[^0-9]", "", value) if kind in ("card", "phone") else value))
        held[text], rest = entities, text
        for pattern in PATTERNS.values():
            rest = regex.sub(pattern, " ", rest)
        plain[text] = set(regex.findall(r"\p{L}+", rest.lower()))
        for term in set(regex.findall(r"\p{L}+", text.lower())):
            n_t[term] = n_t.get(term, 0) + 1
    n = len(texts)
    need = math.log(len(n_t) / doubt)
    least = 1 if math.log(n) >= need else 2
    found = {t: {} for t in texts}

    def evidence(both, one, other):
        share, expected = both / one, other / n
        rest = (one - both) * math.log((1 - share) / (1 - expected)) if both < one else 0
        return both * math.log(share / expected) + rest

    for e in set().union(*held.values()):
        mine = [t for t in texts if e in held[t]]
        if not least <= len(mine) < n:
            continue
        for term in set().union(*(plain[t] for t in mine)):
            both = sum(term in plain[t] for t in mine)
            if n_t[term] < least or n_t[term] >= n:
                continue
            share = math.log2(both * n / (len(mine) * n_t[term])) / math.log2(n / len(mine))
            if share >= generalise and max(evidence(both, len(mine), n_t[term]), evidence(both, n_t[term], len(mine))) >= need:
                for t in mine:
                    if term in plain[t]:
                        found[t][term] = found[t].get(term, False) or share >= remove
    return {
        t: ({w for w, r in f.items() if r or len(w) < 4}, {w for w, r in f.items() if not r and len(w) >= 4})
        for t, f in found.items()
    }


def test_terms_equal_brute_force(spark):
    draw = random.Random(9)
    names = [f"{w}{x}" for w in ("rho", "sigma", "tau", "psi") for x in "abcdefgh"]
    mails = [f"{n}@mail{i % 3}.example.com" for i, n in enumerate(names[:12])] + ["+1 (988) 555-2485", "4111 1111 1111 1111", "10.1.2.3"]
    data = []
    for i in range(400):
        text = prose(5000 + i % 350, 20 + i % 30)
        for _ in range(draw.choice((0, 0, 1, 2))):
            k = draw.randrange(len(mails))
            near = names[k] if draw.random() < 0.8 else draw.choice(names)
            text += f" {near} li {mails[k]} {draw.choice(names)}"
        data.append((1000 + i, text))
    data += [(2000 + i, t) for i, (_, t) in enumerate(data[:40])]  # copies are one witness
    docs = odd_docs(spark, data)
    want = brute_terms([r["text"] for r in docs.collect()])
    treated = 0
    for r in sanitise(docs).collect():
        text = r["text"] or ""
        got = {kind: {text[s["start"] : s["end"]].lower() for s in r["spans"] if s["kind"] == kind} for kind in ("term", "general")}
        base = [(s["start"], s["end"]) for s in r["base"]]
        outside = {
            m[0].lower() for m in regex.finditer(r"\p{L}+", text) if all(m.end() <= a or b <= m.start() for a, b in base)
        }
        removed, general = want[text]
        assert got["term"] == removed & outside and got["general"] == general & outside, text
        treated += bool(removed or general)
    assert treated > 50


def test_thousands_of_entities_and_terms_in_one_text(spark):
    """Entities of the same texts are one, and so are terms, so their pairs are few."""
    words = [f"{a}{b}{c}word" for a in "bcdfghjklm" for b in "aeiou" for c in "bcdfghjklmnpqrstvwxz"]
    mails = " ".join(f"u{i}@many.example.com" for i in range(2000))
    long = f"{' '.join(words)} {mails}"
    data = [(100 + i, f"{long} copy{'abc'[i]}") for i in range(3)] + [(200 + i, prose(i, 50)) for i in range(3000)]
    got = {r["doc_id"]: r for r in sanitise(odd_docs(spark, data)).collect()}
    for i in range(3):
        kinds = [s["kind"] for s in got[100 + i]["spans"]]
        assert kinds.count("email") == 2000 and kinds.count("term") == len(words)
        assert got[100 + i]["sanitised"].startswith("[TERM] [TERM]") and words[0] not in got[100 + i]["sanitised"]
    assert all(got[200 + i]["sanitised"] == t for i, (_, t) in enumerate(data[3:]))
