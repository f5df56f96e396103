"""Personal data: patterns propose spans, checksums confirm them, context adjusts a score.

The base kinds (email, ip, card, phone) are kept as they validate.  Further kinds are added
where validator and context agree: ``iban`` (mod-97), ``card15`` (15 digits, Luhn, with a
payment word nearby) and ``ssn`` (area rules, with an identity word nearby).  So are secrets:
``secret`` (a value assigned to a name such as password or token, with letters, digits and
enough different characters), ``access_key`` (public formats of issued keys and tokens) and
``private_key`` (the first line of a key block).  Every span has its score, the base ones too;
context words are whole words within ``CONTEXT`` code points before or after.  Offsets are
code points.  Everything is regular expressions and array functions inside one row.

The patterns are written so that the regular expression engine never backtracks over a run
it has read: a match may only start at the start of its run or where the last match ended.
That changes no match, and a text of any length takes linear time and constant stack.

Defined results: a null text counts as empty; a text without spans gives zero counts, the
hash of the empty string and an empty ``spans``; repeated rows each get their result; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import text_of

_MAIL = "[A-Za-z0-9._%+-]"
_START = r"(?:\G|(?<![0-9]))"
#: kind: (cheap test, pattern)
PATTERNS = {
    "email": ("@", rf"(?:\G|(?<!{_MAIL})){_MAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"[0-9]\.[0-9]", rf"{_START}[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (r"[0-9]{2}|[0-9][ -][0-9]", rf"{_START}[0-9](?:[\x20-]?[0-9])++"),
    "phone": (r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]"),
    "iban": (r"[A-Z]{2}[0-9]{2}", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "ssn": (r"[0-9]{3}-[0-9]{2}-", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "secret": (
        r"(?i)(?:passw|pwd|secret|token|key)[a-z]{0,6}[\"']?\x20{0,2}[:=]",
        r"(?i)(?<![A-Za-z0-9])(?:password|passwd|pwd|secret|token|(?:api|access|auth|secret)[_-]?key)[\"']?\x20{0,2}[:=]\x20{0,2}[\"']?[^\x00-\x20\"',;]{8,}+",
    ),
    "access_key": (
        r"AKIA|gh[pousr]_|xox[abprs]-|eyJ",
        r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}+|xox[abprs]-[A-Za-z0-9-]{10,}+"
        r"|eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+)(?![A-Za-z0-9])",
    ),
    "private_key": ("-----BEGIN", r"-----BEGIN(?:\x20[A-Z]{1,12}){0,3}\x20PRIVATE\x20KEY-----"),
}
BASE = ["email", "ip", "card", "phone"]
#: Words that make a kind likelier when they stand within CONTEXT code points before or after.
CONTEXT = 40
CONTEXT_WORDS = {
    "email": "e-?mail|mail|contact|write|kontakt|courriel|correo",
    "ip": "ip|address|host|server|login",
    "card": "card|visa|mastercard|credit|pay|payment|karte|kreditkarte|carte|tarjeta",
    "phone": "phone|telephone|tel|call|mobile|fax|anruf|telefon|téléphone|telefono|teléfono",
    "iban": "iban|bank|account|konto|compte|cuenta",
    "card15": "card|amex|credit|pay|payment|karte|kreditkarte|carte|tarjeta",
    "ssn": "ssn|social|security|identity|insurance|taxpayer",
    "secret": "config|credential|login|auth|env|export",
    "access_key": "key|token|secret|credential|auth",
    "private_key": "key|certificate|ssh|pem",
}
#: kind: (score of a validated span, what a context word adds); from KEEP on a span is kept.
SCORES = {
    "email": (0.9, 0.1), "ip": (0.6, 0.2), "card": (0.8, 0.2), "phone": (0.6, 0.3), "iban": (0.9, 0.1), "card15": (0.4, 0.4),
    "ssn": (0.3, 0.5), "secret": (0.8, 0.1), "access_key": (0.9, 0.1), "private_key": (1.0, 0.0),
}
#: Different characters that the value of a secret must have.
SECRET_KINDS = 6
KEEP = 0.5
#: Elements of one block of a running sum.
BLOCK = 256


def running_sums(values: Column) -> Column:
    """Running sums of an array in two levels, so that long arrays stay cheap."""
    zero = F.array(F.lit(0).cast("long"))
    grow = lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x))
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int")),
        lambda b: F.aggregate(F.slice(values, b * BLOCK + 1, BLOCK), zero, grow),
    )
    return F.when(F.size(values) > 0, _joined(blocks, zero, grow)).otherwise(F.array().cast("array<bigint>"))


def _joined(blocks: Column, zero: Column, grow) -> Column:
    starts = F.aggregate(F.transform(blocks, lambda r: F.element_at(r, -1)), zero, grow)
    return F.flatten(
        F.transform(
            F.arrays_zip(blocks.alias("r"), F.slice(starts, 1, F.size(blocks)).alias("s")),
            lambda z: F.transform(F.slice(z["r"], 2, BLOCK), lambda x: x + z["s"]),
        )
    )


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(number)
    double = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    places = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.when((n - i) % 2 == 1, double(F.substring(number, i, F.lit(1)).cast("int"))).otherwise(
            F.substring(number, i, F.lit(1)).cast("int")
        ),
    )
    return F.aggregate(places, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN without blanks leaves remainder 1."""
    turned = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))
    value = lambda c: F.ascii(c) - F.when(c >= "A", 55).otherwise(48)
    rest = F.aggregate(
        F.transform(F.sequence(F.lit(1), F.length(turned)), lambda i: value(F.substring(turned, i, F.lit(1)))),
        F.lit(0),
        lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97,
    )
    return rest == 1


def validated(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        small = lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.right(F.concat(F.lit("000"), p), F.lit(3)).cast("int") <= 255)
        return F.forall(F.split(match, r"\."), small)
    n = F.length(digits(match))
    if kind == "card":
        return F.when((n >= 16) & (n <= 19), luhn(digits(match))).otherwise(False)
    if kind == "card15":
        return F.when(n == 15, luhn(digits(match))).otherwise(False)
    if kind == "phone":
        return (n >= 8) & (n <= 15)
    if kind == "iban":
        plain = F.translate(match, " ", "")
        return F.when((F.length(plain) >= 15) & (F.length(plain) <= 34), mod97(plain)).otherwise(False)
    if kind == "secret":
        value = F.regexp_extract(match, r"[:=]\x20*[\"']?(.*)", 1)
        varied = F.size(F.array_distinct(F.split(value, ""))) >= SECRET_KINDS
        return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & varied
    if kind in ("access_key", "private_key"):
        return F.lit(True)
    area = F.substring(match, 1, 3)
    return (~area.isin("000", "666")) & (area < "900") & (F.substring(match, 5, 2) != "00") & (F.substring(match, 8, 4) != "0000")


def _kind_spans(df: DataFrame, kind: str) -> DataFrame:
    """Adds ``kind``: an array of (start, end, match, near) of every proposed span."""
    test, pattern = PATTERNS[kind]
    has = F.contains("text", F.lit(test)) if test == "@" else F.col("text").rlike(test)
    df = df.withColumn("m", F.when(has, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))))
    df = df.withColumn("gap", F.when(F.size("m") > 0, F.split("text", pattern, -1)))
    df = df.withColumn("step", F.transform("m", lambda x, i: (F.length(F.get("gap", i)) + F.length(x)).cast("long")))
    df = df.withColumn("ends", F.when(F.size("step") > 0, running_sums(F.col("step"))))
    # One code point more than the window shows whether a word begins or ends at its edge;
    # at the edge itself, a word may be cut and is closed off by a letter.
    cut = lambda g, side: F.when(F.length(g) > CONTEXT + 1, side).otherwise("")
    before = lambda g: F.concat(cut(g, "x"), F.right(g, F.lit(CONTEXT + 1)))
    after = lambda g: F.concat(F.left(g, F.lit(CONTEXT + 1)), cut(g, "x"))
    near = lambda i: F.lower(F.concat_ws(" ", before(F.get("gap", i)), after(F.get("gap", i + 1))))
    spans = F.transform(
        "m",
        lambda x, i: F.struct(
            (F.get("ends", i) - F.length(x)).alias("start"), F.get("ends", i).alias("end"), x.alias("match"), near(i).alias("near")
        ),
    )
    empty = F.array().cast("array<struct<start:bigint,end:bigint,match:string,near:string>>")
    return df.withColumn(kind, F.when(F.size("m") > 0, spans).otherwise(empty)).drop("m", "gap", "step", "ends")


def _judged(kind: str, source: str) -> Column:
    """The validated spans of a kind with their scores."""
    valid = F.filter(source, lambda s: validated(kind, s["match"]))
    plain, more = SCORES[kind]
    context = rf"(?<![\p{{L}}\p{{N}}])(?:{CONTEXT_WORDS[kind]})s?(?![\p{{L}}\p{{N}}])"
    scored = F.transform(
        valid,
        lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            F.when(s["near"].rlike(context), F.lit(plain + more)).otherwise(F.lit(plain)).alias("score"),
        ),
    )
    return scored if kind in BASE else F.filter(scored, lambda s: s["score"] >= KEEP)


def find_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, base, added): arrays of (kind, start, end, score), by kind, then start."""
    df = text_of(docs)
    for kind in PATTERNS:
        df = _kind_spans(df, kind)
    base = F.concat(*[_judged(kind, kind) for kind in BASE])
    sources = {"iban": "iban", "card15": "card", "ssn": "ssn", "secret": "secret", "access_key": "access_key", "private_key": "private_key"}
    added = F.concat(*[_judged(kind, source) for kind, source in sources.items()])
    return df.select("doc_id", base.alias("base"), added.alias("added"))


def written(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """Counts per base kind, the digest of the base spans, all spans and their scores, per document."""
    found = find_spans(docs)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(kind) for kind in BASE],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.concat("base", "added")).alias("spans"),
        F.array_join(F.transform(F.concat("base", "added"), lambda s: F.format_number(s["score"], 1)), ",").alias("scores"),
    )
