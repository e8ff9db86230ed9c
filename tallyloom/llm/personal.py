"""Personal data in texts: patterns propose spans, checksums confirm them, nearby words adjust the score.

The base kinds (email, ip, card, phone) are the leftmost non-overlapping matches of fixed patterns that pass
their check (parts up to 255, Luhn, number of digits); they always count. More spans are proposed and count if their score
reaches `MIN_SCORE`: cards and phone numbers inside a run of digits that failed as a whole, spelled-out addresses,
IBANs (mod 97), French, Spanish and US person numbers, local phone numbers, IPv6. A proposal starts from the
trust in its pattern and check; a word that fits within `NEAR` characters adds, one that speaks against it subtracts.

Every pattern is read in time linear in the text: a start is tried once per run of its characters.

Defined cases: a null text is empty and has no spans; a very long text is read whole; repeated rows each get a row;
spans count code points, the end excluded; extra columns are ignored by `personal_data` and kept by `redacted`.
"""

from __future__ import annotations

import ipaddress
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# The kinds in the order in which spans of one start are listed, the first four being the base ones.
KINDS = ("email", "ip", "card", "phone", "iban", "person_id", "ipv6")
BASE = KINDS[:4]
MIN_SCORE = 0.5
NEAR = 40
CONTEXT = 0.3

_RANK = {kind: k for k, kind in enumerate(KINDS)}
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_FOUR_PARTS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_DIGIT_RUN = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PLUS_RUN = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_GROUP = re.compile(r"[0-9]+")
_SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}+(?: ?(?:[(\[]dot[)\]]|\.) ?[A-Za-z0-9-]{1,63}+){1,4}", re.I)
_IBAN = re.compile(r"(?<![A-Za-z0-9])([A-Z]{2})[0-9]{2}(?= ?[A-Z0-9])")
_NIR = re.compile(r"(?<![0-9])[12] ?[0-9]{2} ?(?:0[1-9]|1[0-2]) ?[0-9]{2} ?[0-9]{3} ?[0-9]{3} ?[0-9]{2}(?![0-9])")
_DNI = re.compile(r"(?<![A-Za-z0-9])[0-9]{8}-?[A-Z](?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(.-])\(?0?[0-9]{2,4}\)?[ /-][0-9]{3,4}[ -][0-9]{3,5}(?![0-9.-])")
_IPV6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")

# Lengths of IBANs by country, check letters of the Spanish number.
IBAN_LENGTHS = {
    "AD": 24, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27,
    "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31,
    "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27}
_TAILS = {n: re.compile(r"(?: ?[A-Z0-9]){%d}(?![A-Za-z0-9])" % (n - 4)) for n in set(IBAN_LENGTHS.values())}
_DNI_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"

# Words that speak for a kind, and against it.
_FOR = {
    "email": r"e-?mail|mail|contact|kontakt|correo|courriel|adresse",
    "ip": r"ip|address|adresse|host|server|login|client",
    "card": r"card|visa|mastercard|amex|credit|debit|karte|kreditkarte|carte|tarjeta|payment|cvv",
    "phone": r"tel|phone|call|fax|mobile|cell|telefon|handy|téléphone|portable|teléfono|móvil",
    "iban": r"iban|account|bank|konto|compte|cuenta|bic|swift",
    "person_id": r"ssn|social security|dni|nif|nir|sécurité sociale|insee|identity|passport",
    "ipv6": r"ip|address|host|server"}
_AGAINST = {"ip": r"version|release|section|chapter|build", "card": r"isbn|order|invoice|tracking|serial", "phone": r"order|invoice|isbn|serial"}
_FOR = {kind: re.compile(rf"(?<!\w)(?:{words})(?!\w)", re.I) for kind, words in _FOR.items()}
_AGAINST = {kind: re.compile(rf"(?<!\w)(?:{words})(?!\w)", re.I) for kind, words in _AGAINST.items()}

Span = tuple[int, int, int, float, bool]  # rank of the kind, start, end, score, base


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def mod_97(account: str) -> bool:
    """Whether the account number, without spaces, has the right two check digits."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _digits(text: str) -> str:
    return _NOT_DIGIT.sub("", text)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The name before an at sign is all that may belong to it, back to the last match."""
    free = 0
    for hit in _AT_DOMAIN.finditer(text):
        before = text[free:hit.start()]
        start = free + len(before.rstrip(_LOCAL))
        if start < hit.start():
            yield start, hit.end()
            free = hit.end()
        else:
            free = hit.start() + 1


def _small_parts(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _cards_inside(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """Groups of a failed run that are a whole card number: alone, as 4-4-4-4, or as 4-6-5."""
    groups = [(g.start(), g.end()) for g in _GROUP.finditer(text, start, end)]
    sizes = [b - a for a, b in groups]
    k = 0
    while k < len(groups):
        n = 1 if 13 <= sizes[k] <= 19 else 4 if sizes[k:k + 4] == [4] * 4 else 3 if sizes[k:k + 3] == [4, 6, 5] else 0
        if n and luhn(_digits(text[groups[k][0]:groups[k + n - 1][1]])):
            yield groups[k][0], groups[k + n - 1][1]
            k += n
        else:
            k += 1


def _phone_inside(text: str, start: int, end: int) -> tuple[int, int] | None:
    """The shortest beginning of a run with too many digits that ends with a group and is long enough."""
    held, need = 0, 0
    for g in _GROUP.finditer(text, start, end):
        need = need or (11 if g[0] == "1" else 9)
        held += len(g[0])
        if held >= need:
            return (start, g.end()) if held <= 15 else None
    return None


def _person_numbers(text: str) -> Iterator[tuple[int, int, float]]:
    for hit in _NIR.finditer(text):
        digits = _digits(hit[0])
        if 97 - int(digits[:13]) % 97 == int(digits[13:]):
            yield hit.start(), hit.end(), 0.6
    for hit in _DNI.finditer(text):
        if _DNI_LETTERS[int(hit[0][:8]) % 23] == hit[0][-1]:
            yield hit.start(), hit.end(), 0.4
    for hit in _SSN.finditer(text):
        yield hit.start(), hit.end(), 0.3


def _proposed(text: str) -> Iterator[tuple[str, int, int, float, bool]]:
    """(kind, start, end, trust, base) of everything that passes its check."""
    if "@" in text:
        for start, end in _emails(text):
            yield "email", start, end, 0.8, True
    if "at)" in text or "at]" in text or "AT)" in text or "AT]" in text:
        for hit in _SPELLED.finditer(text):
            yield "email", hit.start(), hit.end(), 0.5, False
    if not _DIGIT.search(text):
        return
    for hit in _FOUR_PARTS.finditer(text):
        if _small_parts(hit[0]):
            yield "ip", hit.start(), hit.end(), 0.6, True
    for hit in _DIGIT_RUN.finditer(text):
        if hit.end() - hit.start() < 12:
            continue
        digits = _digits(hit[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield "card", hit.start(), hit.end(), 0.7, True
        elif len(digits) > 12:
            for start, end in _cards_inside(text, hit.start(), hit.end()):
                yield "card", start, end, 0.6, False
    if "+" in text:
        for hit in _PLUS_RUN.finditer(text):
            if 9 <= len(_digits(hit[0])) <= 15:
                yield "phone", hit.start(), hit.end(), 0.6, True
            else:
                inside = _phone_inside(text, hit.start(), hit.end())
                if inside:
                    yield "phone", *inside, 0.5, False
    for hit in _LOCAL_PHONE.finditer(text):
        if 8 <= len(_digits(hit[0])) <= 13:
            yield "phone", hit.start(), hit.end(), 0.2, False
    for hit in _IBAN.finditer(text):
        tail = _TAILS.get(IBAN_LENGTHS.get(hit[1], 0))
        rest = tail.match(text, hit.end()) if tail else None
        if rest and mod_97(text[hit.start():rest.end()].replace(" ", "")):
            yield "iban", hit.start(), rest.end(), 0.7, False
    for start, end, trust in _person_numbers(text):
        yield "person_id", start, end, trust, False
    if text.count(":") >= 7:
        for hit in _IPV6.finditer(text):
            try:
                ipaddress.IPv6Address(hit[0])
            except ValueError:
                continue
            yield "ipv6", hit.start(), hit.end(), 0.6, False


def find(text: str, min_score: float = MIN_SCORE) -> list[Span]:
    """Spans by start, then kind, then end. An added span that overlaps one of its kind is not listed."""
    found: list[Span] = []
    for kind, start, end, trust, base in _proposed(text):
        near = text[max(0, start - NEAR):start] + "\n" + text[end:end + NEAR // 2]
        score = trust + CONTEXT * bool(_FOR[kind].search(near))
        if kind in _AGAINST:
            score -= CONTEXT * bool(_AGAINST[kind].search(near))
        if base or score >= min_score - 1e-9:
            found.append((_RANK[kind], start, end, round(min(max(score, 0.0), 1.0), 3), base))
    kept: list[Span] = []
    for rank in {s[0] for s in found}:
        base = [s for s in found if s[0] == rank and s[4]]
        added = sorted((s for s in found if s[0] == rank and not s[4]), key=lambda s: (s[1], -s[2]))
        kept += _without_overlaps(base, added)
    return sorted(kept, key=lambda s: (s[1], s[0], s[2]))


def _without_overlaps(base: list[Span], added: list[Span]) -> list[Span]:
    """The base spans, and those of the added ones (both by start) that touch neither them nor each other."""
    out, last, k = list(base), 0, 0
    for span in added:
        while k < len(base) and base[k][2] <= span[1]:
            k += 1
        if span[1] >= last and not (k < len(base) and base[k][1] < span[2]):
            out.append(span)
            last = span[2]
    return out


_FOUND = "array<struct<kind:string,start:int,end:int,score:double,base:boolean>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("base", pa.bool_())])


def _texts(texts: pa.Array) -> Iterator[str]:
    """One text at a time, so that a batch of long texts is not held twice."""
    for text in texts:
        yield text.as_py() or ""


def personal_data(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """(doc_id, spans) of each row; a span has kind, start, end, score, and whether it is one of the base matches."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([[{"kind": KINDS[r], "start": a, "end": b, "score": s, "base": base} for r, a, b, s, base in find(text, min_score)]
                            for text in _texts(texts)], pa.list_(_SPAN))

    spans = F.arrow_udf(run, _FOUND)(F.col("text").cast("string"))
    return docs.select("doc_id", spans.alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of the base spans, and all spans as text."""
    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    counts = [number(kind) for kind in BASE]
    return found.select("doc_id", *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame, min_score: float = MIN_SCORE, mask: Callable[[str], str] = lambda kind: f"[{kind.upper()}]") -> DataFrame:
    """`docs` with every span in `text` replaced by the name of its kind; overlapping spans become one, named by the first."""
    def masked(text: str) -> str:
        out, done = [], 0
        for rank, start, end, _, _ in find(text, min_score):
            if start >= done:
                out += [text[done:start], mask(KINDS[rank])]
            done = max(done, end)
        return "".join(out) + text[done:]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([None if text.as_py() is None else masked(text.as_py()) for text in texts], pa.string())

    return docs.withColumn("text", F.arrow_udf(run, "string")(F.col("text").cast("string")))
