"""Surrogates: nothing private is left, the rest is untouched, entities stay apart and together."""

import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gaugeline.llm import pii, queries

SF = "/root/testdata/sf0.01"
EMAIL = re.compile(r"[\w.%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}")
PHONE = re.compile(r"\+\d \(\d{3}\) \d{3}-\d{4}")
IP = re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)")
CARD = re.compile(r"(?<![\w.+-])\d{16}(?!\w)")
PATTERNS = {"email": EMAIL, "phone": PHONE, "ip": IP, "card": CARD}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def replaced(spark, texts, key="k"):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r.text for r in pii.replace(df, key).orderBy("i").collect()]


def test_query_on_a_table(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id")
    rows = {r.doc_id: r for r in queries.op2_pii(spark, SF).collect()}
    assert set(rows) == set(docs.index)
    pairs: dict[str, dict[str, set[str]]] = {k: {} for k in PATTERNS}
    for i, r in rows.items():
        old, new = docs.text[i], r.text
        assert (r.lang, r.source, r.n_chars) == (docs.lang[i], docs.source[i], docs.n_chars[i])
        if not any(p.search(old) for p in PATTERNS.values()):
            assert new == old
            continue
        cuts = "|".join(f"(?:{p.pattern})" for p in PATTERNS.values())
        assert [x.strip() for x in re.split(cuts, old)] == [x.strip() for x in re.split(cuts, new)], i
        for kind, p in PATTERNS.items():
            a, b = p.findall(old), p.findall(new)
            assert len(a) == len(b)
            for x, y in zip(a, b):
                assert x not in new
                pairs[kind].setdefault(x, set()).add(y)
    for kind, found in pairs.items():
        assert found, kind
        assert all(len(v) == 1 for v in found.values())  # the same entity, the same surrogate
        made = [next(iter(v)) for v in found.values()]
        assert len(set(made)) == len(made) and not set(made) & set(found)  # different ones stay apart
    for x, (y,) in pairs["card"].items():
        assert len(x) == len(y) and luhn(x) == luhn(y)
    assert all(re.fullmatch(r"\+\d \(\d{3}\) 555-\d{4}", y) for (y,) in pairs["phone"].values())
    assert all(max(map(int, y.split("."))) < 256 for (y,) in pairs["ip"].values())


def test_types_and_formats(spark):
    texts = [
        "Mail José.Núñez+x@Sub.Mail-Host.co.uk, or a.b@x.de.", "call +44 20 7946 0958 or (212) 555-0101!", "card 4111 1111 1111 1111, 378282246310005; bad 4111111111111112", "ssn 123-45-6789.",
        "host 192.168.0.1, v1.2.3.4 and 1.2.3.4.5 and 300.1.1.1", "x 10.0.0.1:80",
    ]
    a, b, c, d, e, f = replaced(spark, texts)
    assert re.fullmatch(r"Mail [A-Z][a-z]{3}\.[A-Z][a-z]{4}\+[a-z]@mail[0-9a-f]{10}\.example, or [a-z]\.[a-z]@mail[0-9a-f]{10}\.example\.", a) and "José" not in a
    assert re.fullmatch(r"call \+44 \d\d \d{4} \d{4} or \(\d{3}\) 555-\d{4}!", b) and "7946 0958" not in b and "0101" not in b
    cards = re.fullmatch(r"card (4\d{3} \d{4} \d{4} \d{4}), (3\d{14}); bad (4\d{15})", c).groups()
    assert [luhn(x.replace(" ", "")) for x in cards[:2]] == [True, True] and "1111 1111 1111" not in c
    assert re.fullmatch(r"ssn 9\d\d-\d\d-\d{4}\.", d) and "45-6789" not in d
    assert re.fullmatch(r"host 10\.\d+\.\d+\.\d+, v1\.2\.3\.4 and 1\.2\.3\.4\.5 and 300\.1\.1\.1", e)
    assert re.fullmatch(r"x 10\.\d+\.\d+\.\d+:80", f) and "10.0.0.1:" not in f


def test_neighbours_are_told_apart(spark):
    text = "+1 (017) 555-7713 161.17.88.162 9807915762804490 9807915762804490 a.b@c.de +1 (018) 555-7713"
    (out,) = replaced(spark, [text])
    assert re.fullmatch(r"\+1 \(\d{3}\) 555-\d{4} 10\.\d+\.\d+\.\d+ (9\d{15}) \1 [a-z]\.[a-z]@mail[0-9a-f]{10}\.example \+1 \(\d{3}\) 555-\d{4}", out)
    assert not set(out.split()) & {"(017)", "161.17.88.162", "9807915762804490", "(018)"}


def test_names_keep_gender_script_and_reference(spark):
    texts = ["Mr. John Smith met Mrs. Smith and Ms Ann Lee.", "Later Mr Smith wrote to Frau Ann Schmidt", "господин Иван Петров и госпожа Анна Петрова", "Mr. and The Cat. Mister x"]
    a, b, c, d = replaced(spark, texts)
    he, his, hers, she, lee = re.fullmatch(r"Mr\. (\w+) (\w+) met Mrs\. (\w+) and Ms (\w+) (\w+)\.", a).groups()
    again, ann, schmidt = re.fullmatch(r"Later Mr (\w+) wrote to Frau (\w+) (\w+)", b).groups()
    assert his == hers == again and she == ann and len({he, his, she, lee, schmidt}) == 5
    assert not {"John", "Smith", "Ann", "Lee", "Schmidt"} & {he, his, she, lee, schmidt}
    assert he.endswith(pii.NAME_ENDS["latin", "m"]) and she.endswith(pii.NAME_ENDS["latin", "f"])
    ivan, petrov, anna, petrova = re.fullmatch(r"господин (\w+) (\w+) и госпожа (\w+) (\w+)", c).groups()
    assert anna.endswith(pii.NAME_ENDS["cyrillic", "f"]) and petrova.endswith(pii.NAME_ENDS["cyrillic", "sf"]) and ivan.endswith(pii.NAME_ENDS["cyrillic", "m"])
    assert petrov.endswith(pii.NAME_ENDS["cyrillic", "sm"]) and all(re.fullmatch("[А-Яа-я]+", x) for x in (ivan, petrov, anna, petrova))
    assert d == texts[3]


def test_key_decides(spark):
    text = ["write to some.one@mail1.example.com"]
    assert replaced(spark, text, "a") == replaced(spark, text, "a") != replaced(spark, text, "b")


def test_collisions_are_drawn_again(spark, monkeypatch):
    """Draws from a very small space: surrogates collide with each other and with entities, and none may remain."""
    plain = pii._surrogate

    def narrow(kind, value, draw, key):
        return F.concat(F.lit("10.0.0."), F.pmod(F.xxhash64(plain(kind, value, draw, key)), F.lit(40 + 40 * draw)).cast("string"))

    monkeypatch.setattr(pii, "_surrogate", narrow)
    texts = [f"at 10.0.0.{i} now" for i in range(30)] * 2
    out = replaced(spark, texts)
    made = [x.split()[1] for x in out]
    assert made[:30] == made[30:] and len(set(made)) == 30 and not set(made) & {x.split()[1] for x in texts}


def test_odd_rows(spark):
    long = "word " * 30_000 + "a.b@c.de " * 3000
    rows = [(1, None, 1), (2, "", 2), (3, " ", 3), (3, "x@y.de", 4), (3, "x@y.de", 4), (None, "z@y.de", 5), (4, long, 6), (5, "no entity, just $1 and \\ and {x}", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row int")
    out = pii.replace(df, "k")
    assert out.columns == df.columns
    got = {r._row: r for r in out.collect()}
    assert out.count() == len(rows) and got[1].text is None and [got[i].text for i in (2, 3, 7)] == ["", " ", rows[7][1]]
    assert got[6].text.startswith("word " * 30_000) and len(set(got[6].text.split()[30_000:])) == 1 and "a.b@c.de" not in got[6].text
    assert pii.replace(df.limit(0), "k").collect() == []


@pytest.mark.parametrize("text", ["a@b", "@x.de", "12345678901234567890 1", "+1", "(212)", "1-2-3", "3.14 2,718.28", "id_1234567890123456", "2024-01-02 10:11:12", "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\""])
def test_clean_texts_stay(spark, text):
    assert replaced(spark, [text]) == [text]


def test_no_python_in_the_plan(spark):
    plan = queries.op2_pii(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_a_filled_space_is_widened(spark):
    """All one-letter addresses of a domain, and 27 letters that have 26 places."""
    latin = [f"{c}@one.de" for c in "abcdefghijklmnopqrstuvwxyz"]
    other = [f"{chr(0x4E00 + i)}@two.de" for i in range(27)]
    out = replaced(spark, latin + other)
    assert len(set(out)) == 53 and not set(out) & {*latin, *other}
    assert all(re.fullmatch(r"[a-z]+@mail[0-9a-f]{10}\.example", x) for x in out)


def test_later_draws_have_more_places(spark):
    """Each kind's space grows from the last draw of its own form on, and goes on growing."""
    values = {"email": "a@b.de", "phone": "12125550101", "ip": "1.2.3.4", "ssn": "123-45-6789", "card": "4111111111111111"}
    df = spark.createDataFrame(list(values.items()), "kind string, value string")
    draws = (0, pii.OWN_DRAWS, 2 * pii.OWN_DRAWS, 2 * pii.OWN_DRAWS + 20)
    rows = df.select("kind", *(pii._surrogate(F.col("kind"), F.col("value"), d, "k").alias(str(d)) for d in draws)).collect()
    got = {r.kind: r[1:] for r in rows}
    assert re.fullmatch(r"10(\.\d+){3}", got["ip"][0]) and re.fullmatch(r"2[45]\d(\.\d+){3}", got["ip"][1]) and got["ip"][3].count(".") == 24
    assert len(got["email"][1]) == len(got["email"][0]) + 1
    for kind in ("phone", "ssn", "card"):
        assert [len(x) - len(values[kind]) for x in got[kind]] == [0, 0, 1, 21]
    assert all(luhn(x) for x in got["card"])


@pytest.mark.parametrize("text", ["x@" + "a." * 1_000_000 + "!", "x@" + "ab." * 300_000 + "!", "x@" + "a-" * 500_000 + ".de", "a." * 500_000 + "@b.de", "x@b" * 200_000, "𝐚a" * 200_000 + "@𝐚a.de",
                                  "1." * 500_000, "+" * 500_000, "(212) " * 100_000, "1234 " * 200_000, "1" * 1_000_000, "Mr. " * 200_000, "Mr. " + "Ab " * 200_000, "Mr. A" + "b" * 1_000_000, "+1 " * 300_000, "@." * 400_000],
                         ids=lambda t: f"{t[:8]}")
def test_long_runs_end_no_job(spark, text):
    (out,) = replaced(spark, [f"ok {text} mail q.r@s.de"])
    assert out.startswith("ok ") and "q.r@s.de" not in out


def test_domains(spark):
    texts = ["a@b.de.", "a@b.de..x", "иван@почта.рф!", "a@b.co.uk/x", "a@b-c.de-", "a@b.de1", "r@10.0.0.1", "a@b..de", "a@b.c"]
    out = replaced(spark, texts)
    made = r"[a-zа-я]+@mail[0-9a-f]{10}\.example"
    for text, ends in zip(out, (r"\.", r"\.\.x", "!", "/x", "-", "")):
        assert re.fullmatch(made + ends, text)
    assert re.fullmatch(r"r@10\.\d+\.\d+\.\d+", out[6]) and out[7:] == texts[7:]


def test_one_entity_in_several_forms(spark):
    texts = ["call +1 (212) 555-0101 or +1-212-555-0101", "or (212) 555-0101 or +12125550101", "Bob.Lee@X.com, bob.lee@x.com and BOB.LEE@X.COM", "4111 1111 1111 1111, 4111-1111-1111-1111 or 4111111111111111",
             "+44 20 7946 0958 is +442079460958"]
    a, b, c, d, e = replaced(spark, texts)
    one, two = re.fullmatch(r"call (\+1 \(\d{3}\) 555-\d{4}) or (\+1-\d{3}-555-\d{4})", a).groups()
    three, four = re.fullmatch(r"or (\(\d{3}\) 555-\d{4}) or (\+1\d{10})", b).groups()
    digits = [re.sub(r"\D", "", x) for x in (one, two, three, four)]
    assert len(set(x[-10:] for x in digits)) == 1 and digits[0] == digits[1] == digits[3] != "12125550101"
    first, second, third = re.fullmatch(r"(\S+), (\S+) and (\S+)", c).groups()
    assert first.lower() == second == third.lower() and re.fullmatch(r"[A-Z][a-z]{2}\.[A-Z][a-z]{2}@mail[0-9a-f]{10}\.example", first)
    assert re.fullmatch(r"[A-Z]{3}\.[A-Z]{3}@mail[0-9a-f]{10}\.example", third)
    cards = re.fullmatch(r"(\d{4} \d{4} \d{4} \d{4}), (\d{4}-\d{4}-\d{4}-\d{4}) or (\d{16})", d).groups()
    assert len({re.sub(r"\D", "", x) for x in cards}) == 1 and luhn(cards[2]) and cards[2] != "4111111111111111"
    assert re.fullmatch(r"\+44 \d\d \d{4} \d{4} is \+44\d{10}", e) and len({re.sub(r"\D", "", x) for x in e.split(" is ")}) == 1


def test_many_entities_are_drawn_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(pii, "DRAWS_A_TASK", 10)
    out = replaced(spark, [f"at 9.8.7.{i} now" for i in range(100)])
    assert len(set(out)) == 100 and all(re.fullmatch(r"at 10\.\d+\.\d+\.\d+ now", x) for x in out)


def test_forms_of_names(spark):
    texts = [
        "Mr. J. Smith, Mr. O'Brien, Dr. Smith and MR. SMITH called.",
        "Mrs.\nAnne-Marie  Smith-Jones; Prof. Dr. Ludwig van der Berg.",
        "Smith wrote to Mr. Smith. The Smith family, Smithson and smith stay, SMITH too.",
        "Κύριος Παπαδόπουλος και κυρία Παπαδοπούλου",
        f"Mr. A{'b' * 40} Smith",
        "Ms Word, MS Office and DR Congo",
    ]
    a, b, c, d, e, f = replaced(spark, texts)
    j, smith, brien, again, loud = re.fullmatch(r"Mr\. ([A-Z])\. (\w+), Mr\. O'(\w+), Dr\. (\w+) and MR\. ([A-Z]+) called\.", a).groups()
    assert j != "J" and smith == again and loud == smith.upper() and smith not in ("Smith", brien) and brien != "Brien"
    anne, marie, one, two, ludwig, berg = re.fullmatch(r"Mrs\.\n(\w+)-(\w+)  (\w+)-(\w+); Prof\. Dr\. (\w+) van der (\w+)\.", b).groups()
    assert one == smith and two != "Jones" and anne.endswith(pii.NAME_ENDS["latin", "f"]) and marie.endswith(pii.NAME_ENDS["latin", "f"])
    assert ludwig.endswith(pii.NAME_ENDS["latin", "n"]) and berg.endswith(pii.NAME_ENDS["latin", "s"])
    assert c == f"{smith} wrote to Mr. {smith}. The {smith} family, Smithson and smith stay, SMITH too."
    he, she = re.fullmatch(r"Κύριος (\w+) και κυρία (\w+)", d).groups()
    assert he.endswith(pii.NAME_ENDS["greek", "sm"]) and she.endswith(pii.NAME_ENDS["greek", "sf"]) and re.fullmatch("[Α-ώ]+", he + she)
    assert re.fullmatch(rf"Mr\. \w+ {smith}", e) and "bbb" not in e
    assert re.fullmatch(r"Ms (?!Word)\w+, MS Office and DR Congo", f)


def test_national_numbers_and_ipv6(spark):
    texts = ["212-555-0101, 212.555.0101, 1-212-555-0101 and (212) 555-0101", "020 7946 0958 or 030/1234567", "2001:db8::1 is 2001:0DB8:0:0:0:0:0:1, not fe80::2.",
             "2024-01-02, 10:11:12, std::dead::beef, 1.212.555, 555-0101, 3000 400 500"]
    a, b, c, d = replaced(spark, texts)
    first, second, third, fourth = re.fullmatch(r"(\d{3}-555-\d{4}), (\d{3}\.555\.\d{4}), 1-(\d{3}-555-\d{4}) and (\(\d{3}\) 555-\d{4})", a).groups()
    assert len({re.sub(r"\D", "", x) for x in (first, second, third, fourth)}) == 1 and first != "212-555-0101"
    assert re.fullmatch(r"02\d \d{4} \d{4} or 03\d/\d{7}", b) and "7946 0958" not in b and "1234567" not in b
    one, two, three = re.fullmatch(r"(\S+) is (\S+), not (\S+)\.", c).groups()
    assert one == two != three and all(re.fullmatch(r"2001:0db8(:[0-9a-f]{4}){6}", x) for x in (one, three))
    assert d == texts[3]


def test_domains_stay_apart(spark, monkeypatch):
    """Domains drawn from a very small space: different ones stay different, equal ones equal."""
    plain = pii._surrogate

    def narrow(kind, value, draw, key):
        few = F.concat(F.lit("mail"), F.pmod(F.xxhash64(plain(kind, value, draw, key)), F.lit(25 + 40 * draw)).cast("string"), F.lit(".example"))
        return F.when(kind == "domain", few).otherwise(plain(kind, value, draw, key))

    monkeypatch.setattr(pii, "_surrogate", narrow)
    out = replaced(spark, [f"{c}.b@host{i}.de" for c in "xy" for i in range(20)])
    hosts = [x.split("@")[1] for x in out]
    assert hosts[:20] == hosts[20:] and len(set(hosts)) == 20 and len(set(out)) == 40
