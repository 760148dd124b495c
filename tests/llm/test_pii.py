import hashlib
import re

from pyspark.sql import functions as F

from catalogsync.llm import pii
from llm_cases import ROWS, frame

# The base patterns and checks as stated, in plain Python.
STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for k, c in enumerate(reversed(number)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    found = []
    for place, (kind, pattern) in enumerate(STATED.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), place, m.end(), kind))
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


HARD = [
    "mail a@b.c_d@e.f and x@y..z@w.org or .@d.e then @no a@b a@b.c.@d.e q@r.s- é@é.com a@b.c%d@e.f",
    "ips 1.2.3.4.5.6.7.8 300.1.1.1 001.002.003.004 1.1.1 255.255.255.255.9 1.2.3.256",
    "cards 4111 1111 1111 1111, 4111-1111-1111-1111 41111111111111111 5500 0000 0000 0004 0 4012888888881881x 12  34",
    "phones +1 (656) 555-6510 +49.30.1234567 +1 2 3 +1(212)5551234+44 20 7946 0958 +123456789012345678",
    "日本語 🙂 contact: jürgen@firma.de tel +49 (0)30 123456-78 🙂 ip 10.0.0.1",
    "1 " * 40 + "+" * 30 + "@" * 20,
    "user at example dot com, phone 656-555-6510 call (212) 555-0100, fe80:0:0:0:1:2:3:4, Dr. Anna Smith",
    " ".join(f"10.0.{k % 300}.{k % 7} a{k}@b{k}.org +1 (555) 555-{k:04d} 4111111111111111" for k in range(700)),
    "9" * 20_000, "a" * 50_000 + "@", "a@b" + ".c" * 20_000, "+1" + " " * 20_000, "1 " * 10_000,
]


def test_base_spans_are_as_stated(spark):
    rows = ROWS + list(enumerate(HARD, 100))
    got = pii.find_pii(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        want = base_spans(texts[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), r["doc_id"]
        for kind in STATED:
            assert r[f"n_{kind}"] == want.count(f"{kind}:")
        every = r["spans"].split(",") if r["spans"] else []
        assert [s for s in want.split(",") if s and s not in every] == []
        assert every == sorted(every, key=lambda s: (int(s.split(":")[1]), pii.KINDS.index(s.split(":")[0])))


def test_further_spans_are_learnt(spark):
    """A written-out address with a cue is added; texts without candidates stay as they are."""
    rows = [(k, f"please mail me at jo{k}@site{k}.com or call phone +1 (212) 555-{k:04d}, card 4111111111111111, host 10.1.2.{k}") for k in range(200)]
    rows += [(1000 + k, f"version 1.2.3.{300 + k} order 4111 1111 1111 {1000 + k} invoice +1 22{k}") for k in range(200)]
    rows += [(5000, "contact: anna at example dot com"), (5002, "plain prose and nothing else at all")]
    found = {r["doc_id"]: r["spans"] for r in pii.find_pii(frame(spark, rows)).where("doc_id >= 5000").collect()}
    assert found == {5000: "email:9:32", 5002: ""}


def test_reliabilities_recover_good_and_bad_labelers():
    patterns = [("++++00", 300), ("++-+00", 60), ("0---0-", 200), ("0-+-00", 40), ("+0++0-", 20)]
    truth, table = pii.reliabilities(patterns)
    assert truth[0] > 0.95 and truth[2] < 0.05
    assert table[1, 3, 1] > 0.9 and table[0, 3, 2] > 0.8


def test_no_python_on_the_main_path(spark):
    plan = pii.find_pii(frame(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_empty_tables(spark):
    assert pii.find_pii(frame(spark, [])).count() == 0
    assert pii.find_pii(frame(spark).where(F.lit(False))).count() == 0
