"""Personal data: patterns propose spans, checksums confirm, context words score.

Base spans (contract): email, ip, card, phone.  Further spans come from
weaker patterns that count only with evidence: IBANs that pass mod 97, phone
numbers without ``+`` and card numbers with other separators that stand near a
word that names them.  Every span carries a score: the kind's prior, raised by
a passed checksum and by context words within ``window`` characters.

Null text counts as empty, and gives no spans.  Repeated rows are scanned once
per row; an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rekko.llm.common import map_texts

BASE_KINDS = ("email", "ip", "card", "phone")

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits begins; the look-behind spares the other starts.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
LOCAL_PHONE = re.compile(r"(?<![0-9+.])\(?[0-9]{2,4}\)?[\x20./-][0-9]{3,4}[\x20./-][0-9]{3,4}(?![0-9])")
DOTTED_CARD = re.compile(r"(?<![0-9])[0-9]{4}(?:[./_][0-9]{4}){3}(?![0-9])")

# Words that name a kind of data (fixed values, lower case).
CONTEXT = {
    "email": ("email", "e-mail", "mail", "contact", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "login", "adresse"),
    "card": ("card", "visa", "mastercard", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "telephone", "call", "mobile", "fax", "telefon", "telefono"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
}
NAMED = {k: re.compile(r"(?<![a-z])(?:" + "|".join(map(re.escape, w)) + r")(?![a-z])") for k, w in CONTEXT.items()}
# Score of a proposed span, and of one that a checksum or a range check confirms.
PRIOR = {"email": (0.8, 0.8), "ip": (0.4, 0.6), "card": (0.3, 0.8), "phone": (0.5, 0.6), "iban": (0.4, 0.9)}
CONTEXT_GAIN = 0.2

SPAN = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("score", T.DoubleType()), T.StructField("base", T.BooleanType())]))
SPAN_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                 ("score", pa.float64()), ("base", pa.bool_())]))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 13616 check: first four characters to the end, letters as 10 to 35."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each ``@`` so long runs cost linear time."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and (text[begin - 1].isascii() and (text[begin - 1].isalnum() or text[begin - 1] in "._%+-")):
            begin -= 1
        m = DOMAIN.match(text, at) if begin < at else None
        if m:
            out.append((begin, m.end()))
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", done)
    return out


def only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The contract's spans by kind, then start."""
    out = [("email", a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in DIGITS.finditer(text):
        if 13 <= m.end() - m.start() and 13 <= len(d := only_digits(m.group())) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= len(only_digits(m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def added_spans(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans of the weaker patterns that do not touch a base span or each other."""
    found = []
    m = IBAN.search(text)
    while m:
        # the pattern is greedy: give back trailing groups until the check digits agree
        whole, after = m.group(), m.start() + 1
        for end in [len(whole), *(i for i in range(len(whole) - 1, 14, -1) if whole[i] == " ")]:
            if 15 <= len(c := whole[:end].replace(" ", "")) <= 34 and mod97(c):
                after = m.start() + end
                found.append(("iban", m.start(), after))
                break
        m = IBAN.search(text, after)    # what was given back may hold the next one
    for m in DOTTED_CARD.finditer(text):
        if luhn(only_digits(m.group())):
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in LOCAL_PHONE.finditer(text)]
    # disjoint spans by start: the last one that begins before a span's end is the only one it can touch
    starts: list[int] = []
    ends: list[int] = []
    for _, a, b in sorted(taken, key=lambda x: x[1]):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    out: list[tuple[str, int, int]] = []
    for kind, a, b in found:
        at = bisect_left(starts, b)
        if not at or ends[at - 1] <= a:
            out.append((kind, a, b))
            starts.insert(at, a)
            ends.insert(at, b)
    return out


def score(text: str, kind: str, start: int, end: int, confirmed: bool, window: int) -> float:
    near = text[max(0, start - window):start].lower() + "\n" + text[end:end + window].lower()
    return round(min(1.0, PRIOR[kind][confirmed] + CONTEXT_GAIN * bool(NAMED[kind].search(near))), 3)


def spans_of(text: str, window: int = 40, threshold: float = 0.7) -> list[dict]:
    """All spans of a text by kind (base kinds first), then start."""
    if not any(c in text for c in "@0123456789"):
        return []
    base = base_spans(text)
    out = [dict(kind=k, start=a, end=b, score=score(text, k, a, b, True, window), base=True) for k, a, b in base]
    for k, a, b in added_spans(text, base):
        s = score(text, k, a, b, k != "phone", window)
        if s >= threshold:
            out.append(dict(kind=k, start=a, end=b, score=s, base=False))
    rank = {k: i for i, k in enumerate((*BASE_KINDS, "iban"))}
    return sorted(out, key=lambda x: (rank[x["kind"]], x["start"]))


def find_pii(docs: DataFrame, window: int = 40, threshold: float = 0.7,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and ``spans`` (kind, start, end in code points, score, base).

    ``threshold`` is the score an added span needs; base spans always stay.
    """
    def make(texts: list[str]) -> list[pa.Array]:
        return [pa.array([spans_of(t, window, threshold) for t in texts], SPAN_ARROW)]

    return map_texts(docs, id_col, text_col, [T.StructField("spans", SPAN)], make)


def redacted_column(window: int = 40, threshold: float = 0.7, text_col: str = "text") -> Column:
    """The text with each span as ``[KIND]``, for callers that keep their rows whole."""
    @F.pandas_udf("string")
    def redacted(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: redact(t, spans_of(t, window, threshold)))

    return redacted(F.coalesce(F.col(text_col), F.lit("")))


def redact(text: str, spans: list[dict]) -> str:
    """Replace each span by its kind; overlapping spans become one, named by the first."""
    out, at = [], 0
    for s in sorted(spans, key=lambda x: (x["start"], -x["end"])):
        if s["start"] >= at:
            out += [text[at:s["start"]], f"[{s['kind'].upper()}]"]
        at = max(at, s["end"])
    return "".join(out) + text[at:] if out else text


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def span_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(id_col, *map(count, BASE_KINDS), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
