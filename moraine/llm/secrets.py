"""Secret scan: base formats, and formats inferred from labelled credentials.

Base matches (assign, access, hex) label their credential. For each kind, up to ``sample`` distinct labelled values (those
of least md5) are read as class symbols and grown into a prefix tree on the driver; statistically compatible states, of
whatever depth, are merged into a probabilistic automaton, beside which the lengths of the labelled values are kept. Labelled values may have any length; where values of length n differ at every
depth, merging takes time in the order of n squared. Every other token of 8 or more credential characters, in every
text, is scored by each automaton, and one whose log-likelihood per symbol reaches that of 98 in 100 labelled values is
reported as that kind. Dots may belong to a credential or not: of the runs of a token's dotted parts the longest that an
automaton accepts is taken, from the left.

Null texts count as empty; an empty table or one without credentials gives no spans (no automaton, nothing to score).
Repeated rows get the same spans each; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moraine.llm.automata import Automaton
from moraine.llm.textbytes import lean
from moraine.llm.common import stored, table

SAMPLE = 800
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{32,}")  # shorter runs would be dropped, and runs are maximal
WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
LEAST = 8
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{8,}")


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind number, end, start of the credential), by start, then kind."""
    out = []
    if any(w in low for low in (text.encode("utf-8", "replace").lower(),) for w in WORDS):
        out += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, base: list) -> list[tuple[int, int]]:
    """(start, end) of tokens that no base span touches; of a token with dots, the runs of parts between touched ones."""
    out, k, reach = [], 0, 0
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        if "." not in m.group():
            parts = [(a, b)]
        else:
            parts, at = [], a
            for piece in m.group().split("."):
                parts.append((at, at + len(piece)))
                at += len(piece) + 1
        run = None
        for x, y in parts:
            while k < len(base) and base[k][0] < y:  # reach: the furthest end of base spans that begin before this part's end
                reach = max(reach, base[k][2])
                k += 1
            if reach > x:
                out += [run] if run and run[1] - run[0] >= LEAST else []
                run = None
            else:
                run = (run[0] if run else x, y)
        out += [run] if run and run[1] - run[0] >= LEAST else []
    return out


def accepted(token: str, automata: dict[int, Automaton]) -> list[tuple[int, int, int, float]]:
    """(start, end, kind, score) of the longest runs of dotted parts that an automaton accepts, from the left."""
    if "." not in token:
        s = coded(token)
        best = max(((a.rate(s) - a.floor, k) for k, a in automata.items()), default=(-1.0, -1))
        return [(0, len(token), best[1], best[0])] if best[0] >= 0 else []
    out, at = [], 0
    while len(token) - at >= LEAST:
        stops = []  # (end, score, kind) of accepted runs from here
        head = coded(token[at : at + max((a.depth for a in automata.values()), default=0) + 1])
        for k, a in automata.items():
            for n, rate in a.rates(head):
                if n >= LEAST and (at + n == len(token) or token[at + n] == ".") and rate >= a.floor:
                    stops.append((at + n, rate - a.floor, k))
        if stops:
            end, score, k = max(stops)
            out.append((at, end, k, score))
        else:
            end = at
        dot = token.find(".", end)
        if dot < 0:
            break
        at = dot + 1
    return out


CLASSES = str.maketrans({**dict.fromkeys("0123456789", "0"), **dict.fromkeys("abcdef", "a"), **dict.fromkeys("ghijklmnopqrstuvwxyz", "g"), **dict.fromkeys("ABCDEF", "A"), **dict.fromkeys("GHIJKLMNOPQRSTUVWXYZ", "G")})


def coded(value: str) -> str:
    """The first four characters as written where they are capitals, the rest by class."""
    head = value[:4] if value[:4].isalpha() and value[:4].isupper() else value[:4].translate(CLASSES)
    return head + value[4:].translate(CLASSES)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """kind, value of the labelled credentials of every row, stored."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                kinds, values = [], []
                for t in batch["text"].slice(at, 500).to_pylist():
                    for _, k, end, start in base_spans(t or ""):
                        kinds.append(k)
                        values.append(t[start:end])
                yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(values, pa.string())], ["kind", "value"])

    return stored(docs.select(F.col(text).alias("text")).mapInArrow(lean(run), "kind int, value string").distinct(), "secrets")


def infer(pairs: DataFrame, sample: int = SAMPLE, alpha: float = 0.01) -> dict[int, Automaton]:
    """An automaton for each kind with labelled values (kind, value, distinct)."""
    out = {}
    for k in range(len(KINDS)):
        got = pairs.where(F.col("kind") == k).orderBy(F.md5(F.col("value").cast("binary")), "value").limit(sample).collect()
        if got:
            out[k] = Automaton(sorted((coded(r.value) for r in got), key=lambda s: hashlib.md5(s.encode()).digest()), alpha)
    return out


def detect(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE, alpha: float = 0.01) -> DataFrame:
    """doc_id, base spans, found spans (start, kind, end, score) of every row."""
    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(kept.dtypes)["doc_id"]
    automata = infer(scan(docs, text), sample, alpha)
    shared = docs.sparkSession.sparkContext.broadcast(automata)  # grown from at most sample values a kind
    base = pa.list_(pa.struct([(n, pa.int32()) for n in ("start", "kind", "end", "from")]))
    found = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches):
        own = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                bases, out, known = [], [], {}  # words come again and again
                for t in part["text"].to_pylist():
                    spans, got = base_spans(t or ""), []
                    for a, b in candidates(t or "", spans) if own else ():
                        value = t[a:b]
                        if value not in known:
                            known[value] = accepted(value, own)
                        got += [{"start": a + x, "kind": k, "end": a + y, "score": score} for x, y, k, score in known[value]]
                    bases.append([dict(zip(("start", "kind", "end", "from"), s, strict=True)) for s in spans])
                    out.append(got)
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(bases, base), pa.array(out, found)], ["doc_id", "base", "found"])

    return kept.mapInArrow(lean(run), f"doc_id {kind}, base array<struct<start:int,kind:int,end:int,`from`:int>>, found array<struct<start:int,kind:int,end:int,score:double>>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = detect(table(spark, sf_dir, "documents"))
    names = F.array(*map(F.lit, KINDS))
    key = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    said = lambda spans: F.array_join(F.transform(F.array_sort(F.array_distinct(spans)), lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")
    base, found = F.transform("base", key), F.transform("found", key)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return got.select("doc_id", *(count(k) for k in range(3)), F.sha2(said(base), 256).alias("base_sha256"), said(F.concat(base, found)).alias("spans"), F.size("found").cast("long").alias("n_found"))
