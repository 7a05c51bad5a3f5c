import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from moraine.llm import pii, secrets
from moraine.llm.automata import Automaton
from moraine.llm.spans import located

PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
HARD = ["a@b.c_d@e.f x@y", "1.2.3.4.5 999.1.1.1 01.02.003.0004 1.2.3", "🙂 é a.b@c-d.e. +1 (234) 567-8901 5", "4111 1111 1111 1111", "4111-1111-1111-1111 7 77", "", None, "+12 34 5", "@" * 50, "1" * 60000, "a" * 60000 + "@", "1." * 3000 + "1 " + "4111111111111111 " * 3000, "%%%%@x.y.z@q.w", "a@b-.c..d@e.f"]


def luhn(d):
    return sum(2 * int(c) - 9 * (int(c) > 4) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def valid(kind, v):
    d = re.sub("[^0-9]", "", v)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in v.split(".")), "card": lambda: 16 <= len(d) <= 19 and luhn(d), "phone": lambda: 8 <= len(d) <= 15}[kind]()


def base(text):
    return {k: [m.span() for m in re.finditer(p, text or "") if valid(k, m.group())] for k, p in PII.items()}


def written(spans):
    return ",".join(f"{k}:{a}:{b}" for k in PII for a, b in spans[k])


def test_located_counts_code_points(spark):
    df = spark.createDataFrame([("🙂ab é" * 900,), ("",)], "t string")
    got = df.select(located(F.col("t"), "[a-z]+", 1, 1).alias("x")).collect()
    assert [(s.start, s.end) for s in got[0].x] == [m.span() for m in re.finditer("[a-z]+", "🙂ab é" * 900)] and got[1].x == []
    assert got[0].x[1].pre == "🙂" and got[0].x[1].post == " "


def test_base_formats_on_hard_texts(spark):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(HARD)], "doc_id int, text string, card int")
    for r in pii.detect(df).collect():
        assert {k: [(s.start, s.end) for s in r[k]] for k in PII} == base(HARD[r.doc_id])


def test_pii_query(spark, small_sf):
    got = {r.doc_id: r for r in pii.query(spark, small_sf).collect()}
    for r in spark.read.parquet(f"{small_sf}/documents.parquet").collect():
        b, g = base(r.text), got[r.doc_id]
        assert [g.n_email, g.n_ip, g.n_card, g.n_phone] == [len(b[k]) for k in PII]
        assert g.base_sha256 == hashlib.sha256(written(b).encode()).hexdigest()
        assert set(filter(None, written(b).split(","))) <= set(filter(None, g.spans.split(",")))


def test_contexts_reveal_unseen_identifiers(spark):
    seeds = [f"please call me {'+1 (555) 010-%04d' % i} today friend" for i in range(12)]
    more = ["please call me 5550109999 today friend", "the total was 5550108888 units sold", "see version 2.0.1.x now"]
    df = spark.createDataFrame(list(enumerate(seeds + more)), "doc_id int, text string")
    got = {r.doc_id: [(a.kind, more[r.doc_id - 12][a.start : a.end]) for a in r.added] for r in pii.detect(df).where("doc_id >= 12").collect()}
    assert got == {12: [("phone", "5550109999")], 13: [], 14: []}


def test_values_with_spaces_are_revealed(spark):
    seeds = [f"please call me {'+1 (555) 010-%04d' % i} today friend" for i in range(12)]
    more = ["please call me (555) 010-9999 today friend", "please call me [555 010 9999] today friend"]
    df = spark.createDataFrame(list(enumerate(seeds + more)), "doc_id int, text string")
    got = {r.doc_id: [more[r.doc_id - 12][a.start : a.end] for a in r.added] for r in pii.detect(df).where("doc_id >= 12").collect()}
    assert got[12] == ["(555) 010-9999"] and got[13] == []  # "[555" is another context


def test_doubling_a_text_doubles_the_time(spark):
    import time

    def seconds(n):
        df = spark.createDataFrame([(1, " ".join(f"w{i} user{i}@example.org and {i}.5" for i in range(n)))], "doc_id int, text string")
        at = time.time()
        pii.analysed(df, "doc_id", "text").count()
        return time.time() - at

    seconds(2000)
    assert seconds(40000) < 6 * seconds(10000) + 2


def sliced(text, pattern):
    """(start, end, value, before, behind) of matches, with what lies between them."""
    at = [m.span() for m in re.finditer(pattern, text, re.A)]
    ends, starts = [0] + [e for _, e in at], [a for a, _ in at][1:] + [len(text)]
    return [(a, e, text[a:e], text[x:a], text[e:y]) for (a, e), x, y in zip(at, ends, starts)]


def patterns(before, behind):
    norm = lambda x: re.sub("[0-9]", "0", x.lower())
    before = before[-129:] if len(before) > 128 else " " + before
    behind = behind[:129] if len(behind) > 128 else behind + " "
    two, one, after = (re.search(p, t, re.A) for p, t in ((r"\s(\S+\s+\S+)\s*\Z", before), (r"\s(\S+)\s*\Z", before), (r"^\s*(\S+)\s", behind)))
    return (["L|" + norm(two[1])] if two else []) + (["B|" + norm(one[1]) + "|" + norm(after[1])] if one and after else [])


def added_brute(texts, accept=0.8, support=3):
    seeds, mentions = {}, []
    for n, text in enumerate(texts):
        hidden = list(text)
        for kind, p in PII.items():
            for a, e, v, x, y in sliced(text, p):
                if valid(kind, v):
                    hidden[a:e] = pii.FILL * (e - a)
                    for q in patterns(x, y):
                        seeds.setdefault((q, kind), set()).add(v)
        hidden = "".join(hidden)
        got = [m for m in sliced(hidden, r"(?<!\S)[^\s0-9@]*[0-9@]\S*") if pii.FILL not in m[2]]
        got += [m for m in sliced(hidden, r"[(]?[+]?[0-9](?:[ ().-]{0,3}[0-9])+") if re.search("[ ()]", m[2])]
        for a, e, v, x, y in got:
            while v and (v[0] in "\"'[<" or (v[0] == "(" and ")" not in v)):
                a, v = a + 1, v[1:]
            v = v.rstrip("\"'],>;:!?.")
            v = v if "(" in v else v.rstrip("\"'),]>;:!?.")
            if v:
                mentions.append((n, a, a + len(v), v, patterns(x, y)))
    known = {q for q, _ in seeds}
    edges = {(q, m[3]) for m in mentions for q in m[4] if q in known}
    shapes = {k: re.compile(s.replace("++", "+"), re.A) for k, s in pii.SHAPES.items()}
    fits = lambda k, v: bool(shapes[k].search(v))
    everything = {q: sum(len(s) for (p, _), s in seeds.items() if p == q) + sum(p == q for p, _ in edges) for q in {q for q, _ in edges}}
    graph = [(q, k, v) for q, v in edges for k in PII if fits(k, v) and len(seeds.get((q, k), ())) >= support]
    score = dict.fromkeys(((k, v) for _, k, v in graph), 0.0)
    for _ in range(100):
        sure = {}
        for q, k, v in graph:
            sure[q, k] = sure.get((q, k), len(seeds[q, k])) + score[k, v]
        new = {}
        for q, k, v in graph:
            new[k, v] = new.get((k, v), 1.0) * (1 - min(sure[q, k] / everything[q], 0.999))
        new = {x: 1 - y for x, y in new.items()}
        rise, score = max((new[x] - score[x] for x in score), default=0), new
        if rise <= 0.001:
            break
    best = {}
    for (k, v), s in score.items():
        if s >= accept:
            best[v] = max(best.get(v, (0, "")), (s, k))
    return {(n, best[v][1], a, e) for n, a, e, v, _ in mentions if v in best}


def test_added_spans_against_brute_force(spark, small_sf):
    texts = [r.text or "" for r in spark.read.parquet(f"{small_sf}/documents.parquet").select("text").orderBy("doc_id").collect()]
    texts += [f"reach me under {'+49 30 1234 %03d' % i} or write to user{i}@mail.example now" for i in range(9)]
    texts += ["reach me under 030 9999 123 or write to nobody now", "reach me under 0309999123 or else", "write to root@localhost now"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(4)
    got = {(r.doc_id, a.kind, a.start, a.end) for r in pii.detect(df).select("doc_id", F.explode("added").alias("a")).select("doc_id", "a.*").selectExpr("doc_id", "named_struct('kind', kind, 'start', start, 'end', `end`) as a").collect() for a in [r.a]}
    assert got == added_brute(texts) and len(got) >= 2


def found_brute(text, base, automata):
    """Runs of a token's dotted parts that no base span touches; of these the longest that is accepted, from the left."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9+/_.=-]+", text):
        at, parts = m.start(), []
        for p in m.group().split("."):
            parts.append((at, at + len(p)))
            at += len(p) + 1
        free = [not any(a < max(y, x + 1) and e > x for a, _, e in base) for x, y in parts]
        i = 0
        while i < len(parts):
            for j in range(len(parts) - 1, i - 1, -1):
                a, e = parts[i][0], parts[j][1]
                if e - a >= 8 and all(free[i : j + 1]):
                    s = max((x.rate(secrets.coded(text[a:e])) - x.floor, k) for k, x in automata.items())
                    if s[0] >= 0:
                        out.append((a, s[1], e))
                        i = j
                        break
            i += 1
    return out


def test_found_secrets_against_brute_force(spark, small_sf):
    rng = random.Random(4)
    pick = lambda n, of: "".join(rng.choice(of) for _ in range(n))
    texts = [r.text or "" for r in spark.read.parquet(f"{small_sf}/documents.parquet").select("text").orderBy("doc_id").limit(300).collect()]
    texts += [f"token={pick(5, 'xyz')}.{pick(6, '0123')} AKIA{pick(16, 'QRST0123')}" for _ in range(80)] + [f"see {pick(5, 'xyz')}.{pick(6, '0123')}.org and AKIA{pick(15, 'QRST0')}" for _ in range(10)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(4)
    automata = secrets.infer(secrets.scan(df))
    got = {r.doc_id: [(f.start, f.kind, f.end) for f in r.found] for r in secrets.detect(df).collect()}
    assert got == {i: found_brute(t, secret_base(t), automata) for i, t in enumerate(texts)} and any(got.values())


def test_states_of_several_depths_merge():
    rng = random.Random(3)
    values = ["".join(rng.choice("ab") for _ in range(rng.choice((20, 30)))) for _ in range(300)]
    a = Automaton(values)
    assert len(a.nodes) < 20 and a.rate("ab" * 10) > -1.5 and a.rate("ab" * 12) == float("-inf") and a.rate("c" * 20) == float("-inf")


SECRET = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)), ("access", re.compile("AKIA[A-Z0-9]+")), ("hex", re.compile("[0-9a-f]+"))]


def secret_base(text):
    out = []
    for k, (name, p) in enumerate(SECRET):
        for m in p.finditer(text or ""):
            if len(m.group(2) if name == "assign" else m.group()) >= {"assign": 8, "access": 16, "hex": 32}[name]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_secret_query(spark, small_sf):
    got = {r.doc_id: r for r in secrets.query(spark, small_sf).collect()}
    for r in spark.read.parquet(f"{small_sf}/documents.parquet").collect():
        b, g = secret_base(r.text), got[r.doc_id]
        text = ",".join(f"{SECRET[k][0]}:{a}:{e}" for a, k, e in b)
        assert [g.n_assign, g.n_access, g.n_hex] == [sum(x[1] == k for x in b) for k in range(3)]
        assert g.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(filter(None, g.spans.split(",")))


@pytest.mark.parametrize("text", ["PassWord = 'abcdefgh'", "token=secret=abcdefgh1", "paſſword=abcdefgh", "AKIA" + "A" * 12, "AKIAAKIA", "é🙂 api_key:\"x.y-z/9=\"", "a" * 31, "f" * 33 + "F", None, "", "x" * 5000])
def test_secret_base(text):
    assert [(a, k, e) for a, k, e, _ in secrets.base_spans(text or "")] == secret_base(text)


def test_formats_are_inferred(spark, empty_docs):
    import random

    rng = random.Random(1)
    key = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    labelled = [f"x password={key(18)} y" for _ in range(200)]
    rest = [f"lonely {key(18)} here", f"short {key(17)} here", "Licensed-under-1234-terms ok", "zzzzzzzzzzzzzzz9zz"]
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(labelled + rest)], "doc_id int, text string, base string")
    got = {r.doc_id - 200: len(r.found) for r in secrets.detect(df).where("doc_id >= 200").collect()}
    assert got == {0: 1, 1: 0, 2: 0, 3: 0}
    assert secrets.detect(empty_docs).count() == 0 and pii.detect(empty_docs).count() == 0


def test_formats_of_any_shape_are_inferred(spark):
    rng = random.Random(2)
    pick = lambda n, of: "".join(rng.choice(of) for _ in range(n))
    forms = [lambda: f"{pick(4, '01234')}.{pick(5, 'abcdef')}.{pick(3, '6789')}", lambda: pick(9, "0123456789"), lambda: pick(12, "qrstuvwxyz"), lambda: pick(300, "ghij")]
    labelled = [f"x password={f()} y" for f in forms for _ in range(100)]
    values = [f() for f in forms]
    rest = [f"lonely {v}. Then" for v in values] + ["short " + v[:-1] for v in values[1:3]] + [f"see www.{values[1]}.org", f"password=abcdefgh1.{values[2]} x"]
    df = spark.createDataFrame(list(enumerate(labelled + rest)), "doc_id int, text string")
    got = {r.doc_id - 400: [rest[r.doc_id - 400][f.start : f.end] for f in r.found] for r in secrets.detect(df).where("doc_id >= 400").collect()}
    assert got == {0: values[:1], 1: values[1:2], 2: values[2:3], 3: values[3:], 4: [], 5: [], 6: values[1:2], 7: []}


def test_automaton_keeps_lengths():
    a = Automaton(["ab" * 5] * 50 + ["ab" * 7] * 50)
    assert a.rate("ab" * 5) > -1 and a.rate("ab" * 6) == float("-inf") and a.rate("ba") == float("-inf")
