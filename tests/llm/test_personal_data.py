"""Personal data against plain regular expressions."""

import hashlib
import re

from turnstile.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0


def brute(text):
    spans = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            fine = {
                "email": lambda m=m: True,
                "ip": lambda m=m: all(int(x) <= 255 for x in m.group().split(".")),
                "card": lambda m=m, d=digits: 12 <= len(d) <= 19 and luhn(d),
                "phone": lambda m=m, d=digits: 9 <= len(d) <= 15,
            }[kind]
            if fine():
                spans.append((m.start(), k, m.end()))
    return sorted(spans)


TEXTS = [
    "a@b.c.d@e.f x_y@z-1.co", "a@b.c_d@e.f 1.2.3.4.5.6.7.8 999.1.1.1 01.002.3.4", "+1 (619) 555-0053 and 619-555-0053 call (212) 555-1234",
    "4111 1111 1111 1111 4111-1111-1111-1112 card 4012888888881881 5", "john (at) mail [dot] example (dot) com é+49 30 1234567 ñ 1.1.1.1",
    "é" * 5 + "x@y.zz+1 2 3", "+1+1 234 567 890 1 2 3", "9" * 30_000, "a." * 30_000 + "@", "1 " * 20_000, "", None, "1 2 3 4 5 6 7 8 9 0 1 2 3",
    "x@y z@w.com a@b@c.d", "1.2.3.4@5.6.7.8", "😀 me@x.org 😀 10.0.0.1", "1.2.3.4 " * 500, "+" * 50 + "1" * 12, "a@" * 200 + "b.c",
]


def test_base_spans(docs_of):
    rows = [*enumerate(TEXTS), (None, TEXTS[0]), (0, TEXTS[0])]
    found = pii.find_personal_data(docs_of(rows)).collect()
    assert len(found) == len(rows)
    names = list(PLAIN)
    for r in found:
        spans = brute(TEXTS[r.doc_id or 0])
        listed = [f"{names[k]}:{a}:{b}" for a, k, b in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest(), r.doc_id
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for _, x, _ in spans) for k in range(4)]
        every = r.spans.split(",") if r.spans else []
        assert set(listed) <= set(every) and len(every) == len(listed) + r.n_added
        assert every == sorted(every, key=lambda s: (int(s.split(":")[1]), names.index(s.split(":")[0]), int(s.split(":")[2])))


def test_redact(docs_of):
    docs = docs_of([(1, "é me@x.org, +1 (619) 555-0053"), (2, None), (3, ""), (4, "plain é"), (5, "1.2.3.4@5.6.7.8")])
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert clean == {1: "é [EMAIL], [PHONE]", 2: None, 3: "", 4: "plain é", 5: "[EMAIL]"}
    assert pii.redact(docs).columns == docs.columns


def test_empty_table(docs_of):
    assert pii.find_personal_data(docs_of([])).count() == 0


def test_reliabilities():
    base = {"kind": 0, "context": 0, "size": 16}
    patterns = [
        base | {"shape": 1, "gazetteer": 1, "form": 1, "n": 500},
        base | {"shape": 1, "gazetteer": -1, "form": 1, "n": 40},
        base | {"shape": -1, "gazetteer": -1, "form": -1, "n": 300},
        base | {"shape": -1, "gazetteer": 1, "form": -1, "n": 30},
    ]
    pii.estimate(patterns)
    assert [r["p"] > 0.5 for r in patterns] == [True, True, False, False]
    weights = pii.fit(patterns)
    scores = [sum(weights[f] for f in pii._features(r)) for r in patterns]
    assert [s > 0 for s in scores] == [True, True, False, False]
    pii.estimate([])
    assert pii.fit([]) == {}


def test_no_python_in_the_plan(docs_of):
    plan = pii.find_personal_data(docs_of([(1, "a@b.c")]))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
