"""PII: candidate gradient boosting.

Generators with high recall propose spans, which may overlap: addresses, runs of digits, dotted numbers, keyed values,
long mixed tokens.  Boosted trees score each candidate from its format (lengths, character classes, entropy, checksums)
and its context (neighbouring words and marks).  Scores are calibrated on held-out examples, and each kind's threshold is
chosen there too; among overlapping candidates above their thresholds the most probable one is redacted.

There are no labelled spans in the tables: the trees are trained on examples that this module composes, of personal data
and of look-alikes (versions, dates, amounts, order numbers, commit hashes) in random surroundings.
"""

from __future__ import annotations

import bisect
import math
import random
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from .boosting import Boosted, calibrate
from .common import i64, table, tidied
from .textkit import buffer_of, pieces

KINDS = ("EMAIL", "NUMBER", "DOTTED", "COLONS", "KEYED", "TOKEN")
TAGS = {"EMAIL": "[EMAIL]", "NUMBER": "[NUMBER]", "DOTTED": "[IP]", "COLONS": "[IP]", "KEYED": "[SECRET]", "TOKEN": "[SECRET]"}
#: a kind's threshold is the largest one that keeps this share of its held-out positives, but within these bounds: a secret that
#: stays costs more than a number that goes, so no kind asks for more than the upper one, however well its examples are told apart
RECALL = 0.995
LOWEST, HIGHEST = 0.1, 0.3
FIT_EXAMPLES = 6000

#: every quantifier over an open class is bounded, or possessive over a single class, so that no text makes the search slow
GENERATORS = {
    "EMAIL": re.compile(r"[\w.+%-]{1,64}@[\w-]{1,63}(?:\.[\w-]{1,63}){0,8}"),
    "NUMBER": re.compile(r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?\(?\d{2,19}\)?(?:[ .\-/]{1,2}\(?\d{2,19}\)?){0,8}(?![\w])"),
    "DOTTED": re.compile(r"(?<![\w.])\d{1,5}(?:\.\d{1,5}){1,5}(?!\w)"),
    "COLONS": re.compile(r"(?<![\w:])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,8}(?![\w:])"),
    "KEYED": re.compile(r"""(?P<key>\b\w{2,40})["']?\s{0,3}[=:]\s{0,3}["']?(?P<value>[^\s"',;<>]{4,}+)"""),
    "TOKEN": re.compile(r"(?<![\w/+=-])[A-Za-z0-9_/+=-]{12,}+(?![\w/+=-])"),
}
#: characters by which a KEYED or TOKEN span is described; the span itself has any length
DESCRIBED = 200
_LONG = re.compile(r"\d{9,19}")
_SENSITIVE = re.compile(r"pass|pwd|secret|token|key|auth|cred|bearer|login|api", re.I)
_PERSONAL = re.compile(r"(?:\b|_)(?:e-?mail|mail|phone|call|tel|mobile|fax|ssn|social|security|card|visa|account|iban|contact|address|ip|host|server|from)(?:\b|_)", re.I)
_HARMLESS = re.compile(r"\b(?:version|v|release|chapter|section|page|isbn|order|invoice|issue|commit|sha|revision|build|licen[sc]e|public|date|year|total|price|amount|figure|table|ratio|score|rfc|step|line|BY-NC|CC)\b", re.I)

# bytes one of which a text must hold for a generator to fire: digits (also the first bytes of other scripts' ones) and marks
_SPARK = np.zeros(256, bool)
_SPARK[[*range(48, 58), ord("@"), ord("="), ord(":"), 0xD9, 0xDB, 0xDF, 0xE0, 0xE1, 0xEA, 0xEF, 0xF0]] = True
# but for TOKENs of capitals alone, which need a run of CAPITALS of these bytes
CAPITALS = 16
_CAPITAL = np.zeros(256, bool)
_CAPITAL[[*range(65, 91), *map(ord, "_/+-")]] = True


def _may_hold(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Which of the texts with these offsets, the first at 0, a generator may fire for."""
    count = np.concatenate([[0], np.cumsum(_SPARK[data])])
    some = count[off[1:]] > count[off[:-1]]
    runs = np.concatenate([[0], np.cumsum(_CAPITAL[data])])
    at = np.flatnonzero(runs[CAPITALS:] - runs[:-CAPITALS] == CAPITALS)
    first = np.searchsorted(off, at, side="right") - 1
    some[first[at + CAPITALS <= off[first + 1]]] = True
    return some


def luhn(digits: str) -> bool:
    s = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        s += d - 9 if d > 9 else d
    return s % 10 == 0


def entropy(s: str) -> float:
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in (s.count(x) for x in set(s))) if n else 0.0


def candidates(text: str) -> list[tuple[int, int, str, int]]:
    """(start, end, kind, start of the match) of every proposal; TOKENs and KEYED values need a digit or a mark of a key."""
    out = []
    for kind, rx in GENERATORS.items():
        for m in rx.finditer(text):
            if kind == "KEYED":
                if _SENSITIVE.search(m["key"]) or any(c.isdigit() for c in m["value"]):
                    out.append((*m.span("value"), kind, m.start()))
            elif kind == "TOKEN":
                t = m.group()
                if any(c.isalpha() for c in t) and (any(c.isdigit() for c in t) or len(t) >= CAPITALS and t.isupper()):
                    out.append((*m.span(), kind, m.start()))
            elif kind != "COLONS" or any(c.isalnum() for c in m.group()):
                out.append((*m.span(), kind, m.start()))
                if kind == "NUMBER":  # long groups of a spaced number also stand by themselves
                    alone = [g.span() for g in _LONG.finditer(text, *m.span()) if g.span() != m.span()]
                    out += [(*g, kind, g[0]) for g in alone]
    return out


FEATURES = 34


def describe(text: str, c: tuple[int, int, str, int]) -> list[float]:
    a, z, kind, at = c
    s = text[a : min(z, a + DESCRIBED)] if kind in ("KEYED", "TOKEN") else text[a:z]
    n = len(s)
    digits = re.sub(r"\D", "", s) if s.isascii() else "".join(x for x in s if x in "0123456789")
    upper, lower = sum(map(str.isupper, s)), sum(map(str.islower, s))
    before, after = text[max(0, at - 40) : at], text[z : z + 25]
    key = text[at:a]
    parts = s.split(".")
    groups = re.findall(r"\d+", s)
    quad = len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) < 256 for p in parts)
    near = " ".join(re.split(r"\n|[.!?] ", before)[-1].split()[-2:])
    longest = max(map(len, groups), default=0)
    return [
        KINDS.index(kind), n, len(digits), upper, lower, n - len(digits) - upper - lower, entropy(s), len(digits) / n, len(parts), quad,
        s.count("-"), s.count(":"), s.count("/"), s.count(" "), s[0] == "+", "(" in s, "@" in s, "." in s[s.find("@") :] if "@" in s else 0,
        luhn(digits) if 12 <= len(digits) <= 19 else -1, all(x in "0123456789abcdefABCDEF" for x in s), len(groups), longest,
        bool(_SENSITIVE.search(key)), bool(_PERSONAL.search(key + " " + near)), bool(_HARMLESS.search(key + " " + near)), bool(_SENSITIVE.search(near)),
        before[-1:] in ("", " ", "\n"), before[-1:] in ("$", "€", "#", "v", "£"), after[:1] in ("", " ", "\n", ".", ",", '"', "'", ";", ")"), after[:1] == "%",
        len(groups) == 3 and [len(g) for g in groups] in ([4, 2, 2], [2, 2, 4], [1, 1, 4]), len(groups) == 3 and [len(g) for g in groups] == [3, 2, 4], s.startswith(("AKIA", "ASIA", "ghp_", "sk-", "xox")), int(groups[0]) if groups and len(groups[0]) == 4 else -1,
    ]


# --- examples -----------------------------------------------------------------------------------------------------


def _personal(r: random.Random) -> tuple[str, str]:
    """(text before the span with its key, span)."""
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    low = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    hexa = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    mixed = lambda n: "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    k = r.randrange(11)
    if k == 0:
        name = low(r.randint(2, 9)) + r.choice(["", ".", "_", "+", "-"]) + r.choice([low(r.randint(1, 8)), d(r.randint(1, 4))])
        return r.choice(["", "", "", "email ", "mail: ", "contact "]), f"{name}@{low(r.randint(2, 9))}{r.choice(['', d(1), '-' + low(3), '.' + low(4)])}.{r.choice(['com', 'org', 'net', 'de', 'fr', 'es', 'co.uk', 'io'])}"
    if k == 1:
        cc = r.choice(["+1 ", "+1-", "+44 ", "+49 ", "+33 ", "", "", "+34 "])
        return r.choice(["", "", "", "call ", "phone: ", "tel. "]), cc + r.choice([f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)} {d(3)} {d(4)}", f"{d(3)}.{d(3)}.{d(4)}"])
    if k == 2:
        return r.choice(["", "", "", "from ", "host ", "ip "]), ".".join(str(r.randint(1, 255)) for _ in range(4))
    if k == 3:
        body = r.choice("3456") + d(14)
        if r.random() < 0.5:  # a valid check digit
            body = next(body + c for c in "0123456789" if luhn(body + c))
        else:
            body += d(1)
        return r.choice(["", "", "", "card ", "visa "]), body if r.random() < 0.6 else r.choice([" ", "-"]).join(body[i : i + 4] for i in range(0, 16, 4))
    if k == 4:
        return r.choice(["", "", "ssn ", "social security "]), f"{d(3)}-{d(2)}-{d(4)}"
    if k == 5:
        return r.choice(["password", "passwd", "pwd", "Password", "db_password", "login"]) + r.choice(["=", " = ", ": ", "=\""]), r.choice([hexa(r.randint(8, 20)), mixed(r.randint(6, 16)) + d(1)])
    if k == 6:
        return r.choice(["token", "api_key", "apikey", "secret", "auth_token", "access_key", "client_secret"]) + r.choice([' = "', "=", ": ", ' = ', '="']), r.choice([hexa(r.choice([16, 32, 40, 64])), mixed(r.randint(16, 44)) + d(1)])
    if k == 7:
        return r.choice(["", "", "", "key "]), "AKIA" + "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ" + "234567" * r.randint(0, 1)) for _ in range(16))
    if k == 8:
        return r.choice(["", "token ", "key "]), r.choice(["ghp_", "sk-", "xoxb-"]) + mixed(r.randint(20, 40))
    if k == 9:
        return r.choice(["", "", "from "]), ":".join(hexa(4) for _ in range(8))
    return r.choice(["", "", "iban ", "account "]), r.choice(["DE", "FR", "ES", "GB"]) + d(2) + r.choice(["", mixed(4).upper()]) + d(r.randint(14, 18))


def _harmless(r: random.Random) -> tuple[str, str]:
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    low = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    hexa = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    k = r.randrange(16)
    y = str(r.randint(1500, 2060))
    return [
        lambda: (r.choice(["version ", "License ", "v", "", "release ", "CC BY-NC ", "Section "]), f"{r.randint(0, 20)}.{r.randint(0, 40)}"),
        lambda: (r.choice(["version ", "v", "release ", "build "]), f"{r.randint(0, 20)}.{r.randint(0, 40)}.{r.randint(0, 9999)}" + r.choice(["", f".{r.randint(0, 999)}"])),
        lambda: ("", f"{y}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}"),
        lambda: ("", f"{r.randint(1, 28):02d}/{r.randint(1, 12):02d}/{y}"),
        lambda: (r.choice(["in ", "", "year "]), y),
        lambda: ("", f"{y}-{y}"),
        lambda: (r.choice(["$", "€", "total ", "price "]), f"{d(r.randint(2, 7))}.{d(2)}"),
        lambda: (r.choice(["order ", "invoice ", "issue #", "page ", "ISBN ", "order #"]), d(r.randint(4, 9))),
        lambda: ("ISBN ", f"978-{d(1)}-{d(4)}-{d(4)}-{d(1)}"),
        lambda: (r.choice(["commit ", "sha ", "revision "]), hexa(r.choice([12, 40]))),
        lambda: ("", f"{r.randint(0, 23):02d}:{r.randint(0, 59):02d}:{r.randint(0, 59):02d}"),
        lambda: (low(5) + r.choice(["=", ": "]), r.choice([d(r.randint(4, 6)), low(r.randint(4, 9)) + d(1)])),
        lambda: ("", low(r.randint(5, 9)) + "-" + low(r.randint(4, 8)) + r.choice(["-", "/"]) + d(r.randint(1, 3))),
        lambda: (r.choice(["score ", "ratio ", ""]), f"{d(r.randint(1, 3))}.{d(r.randint(1, 5))}"),
        lambda: ("", d(r.randint(2, 6))),
        lambda: ("@ ", low(4) + "@" + low(r.randint(1, 3))),
    ][k]()


def examples(n: int = FIT_EXAMPLES, seed: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, label, kind) of the candidates that the generators propose in composed sentences."""
    r = random.Random(seed)
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt", "ea", "ti", "to", "it", "st", "io", "le", "is", "ou", "ar", "as", "de", "ue", "él", "ñ", "sch", "ß"]
    word = lambda: "".join(r.choice(parts) for _ in range(r.randint(1, 4)))
    xs, ys, ks = [], [], []
    for _ in range(n):
        good = r.random() < 0.5
        key, span = (_personal if good else _harmless)(r)
        left = " ".join(word() for _ in range(r.randint(0, 8)))
        if r.random() < 0.15:  # a word of either kind of context says little by itself
            left += " " + r.choice(["version", "license", "order", "page", "phone", "mail", "card", "CC BY-NC"])
        left = left + r.choice([" ", " ", " ", ". ", ", ", "\n"]) if left else ""
        right = r.choice([" ", " ", " ", ". ", ", ", "\n", ""]) + " ".join(word() for _ in range(r.randint(0, 6)))
        quote = '"' if key.endswith('"') else ""
        text = left + key + span + quote + right
        a, z = len(left + key), len(left + key + span)
        for c in candidates(text):
            cover = min(z, c[1]) - max(a, c[0])
            if cover <= 0 and good:
                continue
            # a candidate is right if it is nearly the span itself
            ys.append(good and cover >= 0.9 * (z - a) and cover >= 0.9 * (c[1] - c[0]))
            xs.append(describe(text, c))
            ks.append(KINDS.index(c[2]))
    return np.array(xs, float), np.array(ys, float), np.array(ks)


class Model:
    def __init__(self, n: int = FIT_EXAMPLES, seed: int = 5):
        x, y, kind = examples(n, seed)
        held = np.arange(len(y)) % 4 == 0
        self.trees = Boosted().fit(x[~held], y[~held])
        f = self.trees.decision(x[held])
        self.a, self.b = calibrate(f, y[held])
        p = self.probability(f)
        self.at = np.full(len(KINDS), 0.5)
        for k in range(len(KINDS)):
            pos = np.sort(p[(kind[held] == k) & (y[held] > 0)])
            if len(pos):
                self.at[k] = min(HIGHEST, max(LOWEST, pos[int((1 - RECALL) * len(pos))] - 1e-9))

    def probability(self, f: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.a * f + self.b, -30, 30)))

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """The spans to redact, in order and without overlap."""
        return self.spans_of([text])[0]

    def spans_of(self, texts: list[str]) -> list[list[tuple[int, int, str]]]:
        """spans() of each text; the trees see all candidates at once."""
        each = [candidates(t) for t in texts]
        rows = [describe(t, c) for t, cs in zip(texts, each) for c in cs]
        if not rows:
            return [[] for _ in texts]
        p = self.probability(self.trees.decision(np.array(rows, float)))
        at = np.cumsum([0, *map(len, each)])
        return [self._chosen(cs, p[a:z]) for cs, a, z in zip(each, at, at[1:])]

    def _chosen(self, cs, p) -> list[tuple[int, int, str]]:
        chosen: list[tuple[int, int, str]] = []
        good = [(q, c) for q, c in zip(p, cs) if q >= self.at[KINDS.index(c[2])]]
        good.sort(key=lambda x: (-round(x[0], 3), x[1][0] - x[1][1], x[1][0], x[1][2]))
        starts: list[int] = []
        ends: list[int] = []
        for _, (a, z, kind, _) in good:
            i = bisect.bisect_left(starts, a)
            if (i and ends[i - 1] > a) or (i < len(starts) and starts[i] < z):
                continue
            starts.insert(i, a)
            ends.insert(i, z)
            chosen.append((a, z, kind))
        return sorted(chosen)


@lru_cache(maxsize=1)
def model() -> Model:
    return Model()


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    parts, at = [], 0
    for a, z, kind in spans:
        parts += [text[at:a], TAGS[kind]]
        at = z
    return "".join([*parts, text[at:]])


def _run(m: Model, col: pa.Array):
    """(redacted column, number of redactions, spans as text) of a string column; nulls stay null."""
    data, off = buffer_of(col)
    n, told = np.zeros(len(col), np.int64), np.full(len(col), "", object)
    hits, new = [], []
    for first, last in pieces(off):
        some = _may_hold(data[off[first] : off[last]], off[first : last + 1] - off[first])
        rows = np.flatnonzero(some) + first
        texts = [bytes(data[off[k] : off[k + 1]]).decode() for k in rows]
        for k, text, spans in zip(rows, texts, m.spans_of(texts)):
            if spans:
                hits.append(k)
                new.append(redact(text, spans))
                n[k], told[k] = len(spans), ",".join(f"{a}-{z}:{kind}" for a, z, kind in spans)
    if hits:
        mask = np.zeros(len(col), bool)
        mask[hits] = True
        col = pc.replace_with_mask(col, pa.array(mask), pa.array(new, col.type))
    return col, n, told


def redacted(docs: DataFrame) -> DataFrame:
    """doc_id, text with personal data replaced by tags, n_redacted, spans ('start-end:KIND,...', in characters).

    One row per row of docs: repeated rows and null ids are passed on, a null text stays null, texts without candidates
    are unchanged, a text of any length is searched as a whole. Extra columns are not read. Empty in, empty out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model())

    def run(it):
        for b in it:
            text, n, told = _run(shared.value, b.column("text"))
            yield pa.record_batch({"doc_id": b.column("doc_id"), "text": text, "n_redacted": i64(n), "spans": pa.array(told, pa.string())})

    return docs.select("doc_id", "text").mapInArrow(tidied(run), "doc_id long, text string, n_redacted long, spans string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redacted(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: docs with redacted texts (and n_chars, where there is one, of the new text)."""
    from pyspark.sql import functions as F

    shared = docs.sparkSession.sparkContext.broadcast(model())

    def run(it):
        for b in it:
            yield b.set_column(b.schema.get_field_index("text"), "text", _run(shared.value, b.column("text"))[0])

    out = docs.mapInArrow(tidied(run), docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns) if "n_chars" in docs.columns else out
