import re

from pyspark.sql import functions as F

from rosterlake.llm.pii_context import KINDS, Settings, attach, find, mask, shown

from odd_rows import documents, empty, ODD_TEXTS  # noqa: F401  (fixtures)

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    values = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


def valid(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in hit.split(".")),
            "card": lambda: 16 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 8 <= len(digits) <= 15}[kind]()


def base(text):
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k in KINDS for m in re.finditer(PATTERNS[k], text or "") if valid(k, m[0]))


TRICKY = [
    "a@b.c._x@d.e f@g..h i@j k@l.m.n @o.p q@r@s.t", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4 1.2.3 99999999999.1.1.1 1.2.3.4",
    "4539 1488 0343 6467 4539148803436467 4539-1488-0343-6467 4539148803436467123456 4539  1488 0343 6467 5 6 7",
    "+1 (017) 555-7713, +12, +1234567890123456 ++44 20 7946 0958- +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5",
    "é漢 x@y.z 😀 10.0.0.1 +49 30 1234567", "7" * 5000, "1 " * 5000, "a" * 20000 + "@b.c", "z@z.z " * 400, "-" * 3000 + "a@b.cc",
]


def spans(docs, **options):
    found = attach(docs, find(docs, **options), F.col("doc_id"))
    return {r.row: (r.base, r.all) for r in found.select("row", shown(F.col("base")).alias("base"), shown(F.col("all")).alias("all")).collect()}


def test_base_spans(documents, empty):
    texts = ODD_TEXTS + TRICKY
    docs = documents([(i, t) for i, t in enumerate(texts)] + [(None, "x@y.z"), (3, "word")], extra=("k1", "row", "kind", "base"))
    got = spans(docs)
    for i, text in enumerate(texts):
        assert got[i][0] == base(text), (i, text and text[:80])
    assert got[None][0] == "email:0:5"
    assert attach(docs, find(docs), F.col("doc_id")).count() == len(texts) + 2
    assert attach(empty, find(empty), F.col("doc_id")).count() == 0


def test_contexts_discover_what_no_pattern_matches(documents):
    known = [(i, f"some words {i} tel: +1 (017) 555-7{i:03d} more text") for i in range(12)]
    unseen = [(100, "please dial tel: 5551234 tonight"), (101, "the total: 5551234 tonight"), (102, "room 5551235, tel: none")]
    got = spans(documents(known + unseen), settings=Settings())
    assert got[100] == ("", "phone:17:24") and got[102][1] == ""
    assert all(got[i][0] == got[i][1] != "" for i in range(12))


def test_discovered_identifiers_induce_patterns(documents):
    known = [(i, f"some words {i} tel: +1 (017) 555-7{i:03d} more text") for i in range(60)]
    shared = [(100 + i, f"w{i}w tel: 55510{i:02d} x{i}x") for i in range(20)] + [(200 + i, f"y{i}y hotline 55510{i:02d} z{i}z") for i in range(20)]
    further = [(300 + i, f"a{i}a hotline 77720{i:02d} b{i}b") for i in range(8)] + [(400 + i, f"c{i}c desk 77720{i:02d} d{i}d") for i in range(8)]
    got = spans(documents(known + shared + further + [(900, "my hotline 7771234 now"), (901, "my desk 8881234 now"), (902, "my lamp 8881239 now")]))
    assert got[900] == ("", "phone:11:18") and got[901] == ("", "phone:8:15") and got[902] == ("", "")


def test_masking(documents):
    docs = documents([(1, "mail a@b.cc or 10.0.0.1!"), (2, None), (3, "clean"), (4, "+4539148803436467 x")], extra=("place",))
    got = {r.doc_id: r for r in mask(docs).collect()}
    assert got[1].text == "mail [email] or [ip]!" and got[1].n_chars == len(got[1].text)
    assert got[2].text is None and got[3].text == "clean" and got[4].text == "+[card] x" and got[1].place == "x1"
    assert mask(docs).dtypes == docs.dtypes
