import hashlib
import random
import re

from citylens.llm import pii as P


def brute(text):
    """Straight from the rules: the patterns as written, then the checks."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        s = sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])
        if 14 <= len(d) <= 19 and s % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda x: (x[1], ["email", "ip", "card", "phone"].index(x[0])))


def test_base_spans_against_the_patterns():
    rnd = random.Random(2)
    pieces = ["a.b+c@x.y-z.com", "@", "..", "1.2.3.4", "300.1.1.1.2.3.4.5", "4716 2210 5188 5662", "4716-2210-5188-5662", "00000000000000",
              "+1 (555) 010-2030", "+1..", "+", "x@y", "é", " ", "\n", "1", "9", "-", "(", ")", "user@", "@host.org", "a@b.c@d.e", "1.1.1.1.1"]
    for _ in range(6000):
        t = "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 9)))
        assert [s[:3] for s in P.find(t) if s[4]] == brute(t), t
    for _ in range(6000):
        t = "".join(rnd.choice("a1@.+- ()9é") for _ in range(rnd.randint(0, 40)))
        assert [s[:3] for s in P.find(t) if s[4]] == brute(t), t


def test_long_runs_stay_linear():
    n = 300_000
    for t in ("a" * n + " b@c.de", "1" * n, "1." * n, "+1" + "(" * n, "1 " * n, "@" * n, "a" * n + "@"):
        P.find(t)


def test_quads_of_very_many_zeros():
    zeros = "0" * 5000                    # int() refuses texts of over 4,300 digits
    for t in (f"{zeros}.0.0.0", f"ip 1.{zeros}255.{zeros}.7"):
        assert ("ip", t.rindex(" ") + 1 if " " in t else 0, len(t)) in [s[:3] for s in P.find(t)]
        assert P.redacted(t).endswith("[IP]")
    assert P.find(f"{zeros}256.0.0.0") == []


def test_method_adds_confirmed_spans_only():
    assert [s[0] for s in P.find("IBAN GB82 WEST 1234 5698 7654 32 please")] == ["iban"]
    assert P.find("code GB83 WEST 1234 5698 7654 32") == []
    assert [s[0] for s in P.find("visa 4222222222222 ok")] == ["card13"] and P.find("id 4222222222222 ok") == []
    assert [s[0] for s in P.find("call (212) 555-0142 now")] == ["phone_local"] and P.find("ref (212) 555-0142 now") == []
    assert [s[0] for s in P.find("SSN 078-05-1120")] == ["ssn"] and P.find("part 078-05-1120") == []
    with_word, without = P.find("mail to a@b.co")[0][3], P.find("zzz to a@b.co")[0][3]
    assert with_word > without
    assert P.luhn("4716221051885662") and not P.luhn("4716221051885663")


def test_digest_rows(spark):
    rows = [(1, "x é a@b.co 1.2.3.4", 5), (2, None, 5), (2, "", 5), (None, "+1 (555) 010-2030", 5), (1, "x é a@b.co 1.2.3.4", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    got = sorted(((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"], r["spans"]) for r in P.digest(docs).collect()), key=str)
    want = []
    for i, t, _ in rows:
        b = brute(t or "")
        line = ",".join(f"{k}:{s}:{e}" for k, s, e in b)
        want.append((i, *[sum(x[0] == k for x in b) for k in P.BASE_KINDS], hashlib.sha256(line.encode()).hexdigest(), line))
    assert got == sorted(want, key=str)
    assert P.digest(docs.limit(0)).count() == 0


def test_redact_keeps_columns_and_clean_texts(spark):
    docs = spark.createDataFrame([(1, "to a@b.co, +1 (555) 010-2030!", "q"), (2, "clean", "q"), (3, None, "q")], "doc_id long, text string, TEXT2 string")
    out = P.redact(docs)
    assert out.columns == docs.columns
    assert [r["text"] for r in out.orderBy("doc_id").collect()] == ["to [EMAIL], [PHONE]!", "clean", None]
