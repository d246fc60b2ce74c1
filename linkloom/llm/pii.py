"""Personal data by anchor expansion.

One Aho-Corasick automaton finds the anchors of all kinds in a single pass over a text: at-signs,
plus signs, digits, schemes and the words that announce an account number. From each anchor a local
parser walks to the boundaries of the value and validates it. Parsers only move forward past the end of the
last match of their kind, so that a text is read in linear time however many anchors it has.

Base kinds are ``email``, ``ip``, ``card`` and ``phone``, as leftmost matches that do not overlap within
their kind. Added kinds are ``account`` (an account, passport or social security number after
a word that says so; IBANs with their check digits) and ``userinfo`` (name and password in a URL).

Defined results: null counts as empty; texts without personal data have zero counts, the digest of the empty
string and no spans. Rows that repeat give equal results, a null id stays null. An empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.common import ship_package, table
from linkloom.llm.words import batches_by_bytes

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("account", "userinfo")

# What a value of each kind looks like from its first character on.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")
USERINFO = re.compile(r"[A-Za-z0-9._~%!$&'()*+,;=-]{1,256}:[A-Za-z0-9._~%!$&'()*+,;=:-]{0,256}(?=@[A-Za-z0-9])")
ACCOUNT = re.compile(r"(?:[\x20]?(?:no|number|nr|id|num)\b\.?)?[\x20:#=]{0,4}([A-Za-z]{0,2}[0-9](?:[\x20-]?[A-Za-z0-9]){4,33})", re.IGNORECASE)
IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?:\x20?[A-Za-z0-9]){11,30}")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
CUES = ("account", "acct", "iban", "passport", "ssn")
SCHEMES = ("ftp://", "http://", "https://")


def _automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for digit in "0123456789":
        automaton.add_word(digit, ("digit", 1))
    automaton.add_word("@", ("at", 1))
    automaton.add_word("+", ("plus", 1))
    for scheme in SCHEMES:
        automaton.add_word(scheme, ("scheme", len(scheme)))
    for cue in CUES:
        for form in (cue, cue.capitalize(), cue.upper()):
            automaton.add_word(form, ("cue", len(form)))
    automaton.make_automaton()
    return automaton


_anchors = _automaton()


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def passes_iban(value: str) -> bool:
    """Whether the check digits of an account number of at most 34 characters fit."""
    value = value.replace(" ", "").upper()
    return 15 <= len(value) <= 34 and int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def _digits(value: str) -> str:
    return "".join(c for c in value if "0" <= c <= "9")


def _account_end(text: str, begin: int) -> tuple[int, int] | None:
    """The bounds of the account number announced by a word that ends at ``begin``."""
    found = ACCOUNT.match(text, begin)
    if not found:
        return None
    iban = IBAN.match(text, found.start(1))
    if iban:
        # A word may follow the number: the longest prefix with fitting check digits counts.
        for end in range(iban.end(), found.start(1) + 14, -1):
            if text[end - 1] != " " and passes_iban(text[found.start(1) : end]):
                return found.start(1), end
    plain = re.compile(r"[A-Za-z]{0,2}[0-9](?:-?[0-9]){4,19}").match(text, found.start(1))
    return (plain.start(), plain.end()) if plain else None


def personal_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, by kind as listed above and then by start."""
    spans: dict[str, list[tuple[int, int]]] = {kind: [] for kind in (*BASE_KINDS, *ADDED_KINDS)}
    done = dict.fromkeys(spans, 0)  # where the last match of a kind ends
    run_end = 0
    for last, (what, length) in _anchors.iter(text):
        if what == "digit":
            if last < run_end:
                continue
            run_end = DIGITS.match(text, last).end()
            if last >= done["ip"] and run_end < len(text) and text[run_end] == "." and (found := IP.match(text, last)):
                done["ip"] = found.end()
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found[0].split(".")):
                    spans["ip"].append(found.span())
            if last >= done["card"] and (found := CARD.match(text, last)):
                done["card"] = found.end()
                if 13 <= found.end() - found.start() and 13 <= len(d := _digits(found[0])) <= 19 and passes_luhn(d):
                    spans["card"].append(found.span())
        elif what == "at":
            begin = last
            while begin > done["email"] and text[begin - 1] in LOCAL:
                begin -= 1
            if begin < last and (found := EMAIL.match(text, begin)):
                done["email"] = found.end()
                spans["email"].append(found.span())
        elif what == "plus":
            if last >= done["phone"] and (found := PHONE.match(text, last)):
                done["phone"] = found.end()
                if 9 <= len(_digits(found[0])) <= 15:
                    spans["phone"].append(found.span())
        elif what == "scheme":
            if found := USERINFO.match(text, last + 1):
                spans["userinfo"].append(found.span())
        elif last - length < 0 or not text[last - length].isalnum():
            if last + 1 >= done["account"] and (bounds := _account_end(text, last + 1)):
                done["account"] = bounds[1]
                spans["account"].append(bounds)
    return [(kind, low, high) for kind, found in spans.items() for low, high in found]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{low}:{high}" for kind, low, high in spans)


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, found`` of every row of ``docs``; ``found`` is an array of (kind, start, end)."""
    ship_package(docs.sparkSession)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_by_bytes(whole, "text"):
                found = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in personal_spans(t or "")] for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(span))], ["doc_id", "found"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, found array<struct<kind: string, start: bigint, end: bigint>>")


def span_digests(found: DataFrame) -> DataFrame:
    """Counts per base kind, the digest of the base spans and all spans as text."""

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *[count(kind) for kind in BASE_KINDS], F.sha2(text(base), 256).alias("base_sha256"), text(F.col("found")).alias("spans"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digests(find_personal(table(spark, sf_dir, "documents")))
