"""Personal data: surrogate generation.

Detected entities (mail and network addresses, phone, card and social-security numbers, account
numbers, keys, passwords and tokens, names after a form of address and their later mentions without one
in the same text) get surrogates made by a keyed hash of the entity's canonical form: the same entity has
the same surrogate wherever it stands, and the surrogate keeps type, length, punctuation, letter case and
script, for names the gender too, for network addresses the class (private stays private), for cards the
check digit. A phone number with and without the country code 1 is one entity. All distinct entities are
then checked against each other: where two share a surrogate, or a surrogate is itself an entity of the
corpus, all but one are hashed anew until none do, so that different entities stay different. (Where real
entities fill more than the first half of the attempts, as in a small address class, only the surrogates
are still told apart.) Those few exceptions are joined to the documents.

The key is a secret of the caller: ``spark.quirework.surrogateKey``, or one made for the run. Without the
key nobody can try candidates against a surrogate.

Null texts stay null; empty texts and texts without entities are unchanged; every pattern takes time in
proportion to the text, however long; repeated rows get equal replacements; a column named ``n_entities``
is replaced; an empty table has an empty result.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import secrets
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm._common import settled, slices, small_batches

#: Rehashed entities up to which they are broadcast (under 10 MB); more are joined by document.
FEW = 50_000
ROUNDS = 20
#: Session setting with the key.
KEY_CONF = "spark.quirework.surrogateKey"

# Forms of address by gender, and the patterns of each type in order of precedence.
_MALE = ("Mr", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "господин", "κύριος")
_FEMALE = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Sra", "госпожа", "κυρία")
_ADDRESS = {**dict.fromkeys(_MALE, "m"), **dict.fromkeys(_FEMALE, "f")}
_IPV4 = r"(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)"
_IPV6 = r"(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"
# Digits after the country code, for codes whose full numbers have one length; such a number ends there.
_LENGTHS = {
    8: "45 47 65 216 370 371 372 852",
    9: "27 31 33 34 41 48 51 56 61 94 212 233 254 351 380 420 421 593 886 966 971",
    10: "7 44 52 57 58 63 82 90 91 92 98 234",
    11: "86",
}
# Between two groups of a phone number: a space does not lead into an address or a number with its own marks.
_GAP = rf"(?:[.-]| (?!{_IPV4}|{_IPV6}|\d+[,:/]\d))"
_JOIN = rf"(?:\)?{_GAP}\(?|\)|\()"
_FULL = "|".join(rf"(?:{codes.replace(' ', '|')})(?:{_GAP}?\(0\))?{_JOIN}?\d(?:(?:{_JOIN}(?=\d\)?\d))?\d){{{n - 1}}}" for n, codes in _LENGTHS.items())
_PHONE = "|".join([
    rf"(?<![\w.+])\+(?:1{_GAP}?(?:\(\d{{3}}\)|\d{{3}}){_GAP}?\d{{3}}{_GAP}?\d{{4}}|{_FULL})(?!\d)",
    rf"(?<![\w.+])\+\d{{1,3}}{_GAP}?(?:\(\d{{1,4}}\){_GAP}?)?\d{{2,4}}(?:{_GAP}?\d{{2,4}}){{1,3}}(?!\d)",
    r"(?<![\w.])\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)|(?<![\w.-])\d{3}[ .-]\d{3}[ .-]\d{4}(?!\d)",
])
_PATTERNS = [
    ("email", re.compile(r"(?<![A-Za-z0-9._%+-])[._%+-]*(?P<v>[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})")),
    ("key", re.compile(r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])|(?<![A-Za-z0-9])(?:ghp|gho|ghs)_[A-Za-z0-9]{36}(?![A-Za-z0-9])|(?<![A-Za-z0-9])sk_live_[A-Za-z0-9]{16,}")),
    ("secret", re.compile(r"""(?i)(?<![a-z])(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)["']?\s*[=:]\s*["']?(?P<v>[^\s"',;]{6,})""")),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")),
    ("card", re.compile(r"(?<![\d.-])[3-6]\d{3}[ -]?\d{4}[ -]?\d{4}[ -]?\d{3,4}(?!\d)|(?<![\d.-])3[47]\d{2}[ -]?\d{6}[ -]?\d{5}(?!\d)")),
    ("phone", re.compile(_PHONE)),
    ("ssn", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")),
    ("ip", re.compile(rf"(?<![\d.]){_IPV4}|(?<![0-9A-Fa-f:]){_IPV6}")),
]
_WORD = r"[^\W\d_](?:['’-]?[^\W\d_])+"
_NAME = re.compile(rf"(?<!\w)(?P<a>{'|'.join(sorted(_ADDRESS, key=len, reverse=True))})\.? (?P<n>{_WORD}(?: {_WORD})?)")
_SYLLABLES = {
    "latin": "ba be bo da de do fa fe go ha ke la le li lo ma me mi mo na ne ni no pa ra re ri ro sa se so ta te ti to va ve vi wa zo".split(),
    "cyrillic": "ба бе бо да де до ва ве го за зо ка ке ко ла ле ли ло ма ме ми мо на не ни но па по ра ре ри ро са се со та те ти то ха".split(),
    "greek": "βα βε βο γα γε γο δα δε δο ζα ζο θα θε κα κε κο λα λε λι λο μα με μι μο να νε νι νο πα ρα ρε ρι ρο σα σε σο τα τε".split(),
}
_ENDS = {"latin": ("a", "n"), "cyrillic": ("а", "н"), "greek": ("α", "ς")}

Span = tuple[int, int, str, str]


def find(text: str | None) -> list[Span]:
    """(start, end, kind, canonical form) of the entities of a text, none overlapping another."""
    if not text:
        return []
    spans: list[Span] = []
    taken = bytearray()

    def add(a: int, b: int, kind: str, form: str) -> None:
        if not taken:
            taken.extend(bytes(len(text)))
        if taken.find(1, a, b) < 0:
            taken[a:b] = b"\1" * (b - a)
            spans.append((a, b, kind, form))

    if re.search(r"[@\d=:]", text):
        for kind, pattern in _PATTERNS:
            if (kind == "email" and "@" not in text) or (kind == "secret" and not re.search(r"[=:]", text)):
                continue
            for m in pattern.finditer(text):
                a, b = m.span("v") if kind in ("secret", "email") else m.span()
                add(a, b, kind, canonical(kind, text[a:b]))
    if any(w in text for w in _ADDRESS):
        named: dict[str, str] = {}
        for m in _NAME.finditer(text):
            at = m.start("n")
            words = list(re.finditer(r"\S+", m["n"]))
            words = words[: 1 if len(words) > 1 and not words[1][0][0].isupper() else 2]
            if not words[0][0][0].isupper():
                continue
            for i, w in enumerate(words):
                kind = f"given_{_ADDRESS[m['a']]}" if i == 0 and len(words) == 2 else "surname"
                add(at + w.start(), at + w.end(), kind, w[0].casefold())
                # later mentions of a surname may stand alone; so may those of a given name that is none of the words of address
                if len(w[0]) > 2 and w[0] not in _ADDRESS:
                    named.setdefault(w[0], kind)
                    named.setdefault(w[0].upper(), kind)
        if named:
            for m in re.finditer(rf"(?<!\w)(?:{'|'.join(map(re.escape, sorted(named, key=len, reverse=True)))})(?!\w)", text):
                add(*m.span(), named[m[0]], m[0].casefold())
    return sorted(spans)


def canonical(kind: str, raw: str) -> str:
    """The form that all spellings of one entity share."""
    if kind in ("email", "ip"):
        return ipaddress.ip_address(raw).compressed if kind == "ip" and ":" in raw else raw.lower()
    if kind == "phone":
        digits = re.sub(r"\D", "", raw)
        return digits if raw[0] != "+" else digits[1:] if digits[0] == "1" and len(digits) == 11 else f"+{digits}"
    if kind in ("card", "ssn"):
        return re.sub(r"\D", "", raw)
    return re.sub(r"\s", "", raw) if kind == "iban" else raw


class Stream:
    """Keyed pseudo-random numbers for one entity."""

    def __init__(self, key: str, kind: str, form: str, attempt: int):
        self.seed = hashlib.blake2b(f"{kind}\0{attempt}\0{form}".encode(), key=key.encode()[:64]).digest()
        self.n, self.have = 0, int.from_bytes(self.seed, "big")

    def below(self, n: int) -> int:
        if self.have < n << 64:
            self.n += 1
            self.have = int.from_bytes(hashlib.blake2b(self.seed + self.n.to_bytes(4, "big")).digest(), "big")
        self.have, out = divmod(self.have, n)
        return out

    def like(self, c: str) -> str:
        """A character of the same class: digit, small or capital letter; others stay."""
        if c.isascii() and c.isdigit():
            return chr(48 + self.below(10))
        return chr((97 if c.islower() else 65) + self.below(26)) if c.isascii() and c.isalpha() else c


def luhn_digit(digits: str) -> str:
    total = sum(d if i % 2 else d // 5 * -9 + 2 * d if d > 4 else 2 * d for i, d in enumerate(map(int, reversed(digits))))
    return str(-total % 10)


# The address blocks that are not routed; a surrogate stays in the block of its address.
_BLOCKS = [ipaddress.ip_network(x) for x in ("10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16", "127.0.0.0/8", "169.254.0.0/16", "100.64.0.0/10", "224.0.0.0/4", "240.0.0.0/4", "0.0.0.0/8")]


def _address(s: Stream, form: str) -> str:
    if ":" in form:
        return ipaddress.ip_address(f"2001:db8:{':'.join(f'{s.below(65536):x}' for _ in range(6))}").compressed
    own = next((b for b in _BLOCKS if ipaddress.ip_address(form) in b), None)
    if own:
        return str(own[s.below(own.num_addresses)])
    while True:
        out = ipaddress.ip_address((1 + s.below(223)) << 24 | s.below(1 << 24))
        if not any(out in b for b in _BLOCKS):
            return str(out)


def _name(s: Stream, kind: str, form: str, attempt: int) -> str:
    """As many letters as the form has (longer after many attempts), its hyphens and apostrophes in their places."""
    script = "cyrillic" if re.search("[а-яё]", form) else "greek" if re.search("[α-ωά-ώ]", form) else "latin"
    parts = _SYLLABLES[script]
    letters = sum(c.isalpha() for c in form) + attempt // 4
    new = "".join(parts[s.below(len(parts))] for _ in range(-(-letters // 2)))[:letters]
    end = {"given_f": _ENDS[script][0], "given_m": _ENDS[script][1]}.get(kind, "")
    left = iter(new[: len(new) - len(end)] + end)
    return "".join(next(left) if c.isalpha() else c for c in form) + "".join(left)


def surrogate(key: str, kind: str, form: str, attempt: int = 0) -> str:
    """The canonical form of the entity's surrogate."""
    s = Stream(key, kind, form, attempt)
    if kind == "email":
        local, _, domain = form.partition("@")
        labels = domain.split(".")
        return f"{''.join(map(s.like, local))}@{''.join(map(s.like, labels[0]))}.example.{'org' if labels[-1] != 'org' else 'net'}"
    if kind == "ip":
        return _address(s, form)
    if kind == "card":
        body = form[0] + "".join(str(s.below(10)) for _ in form[2:])
        return body + luhn_digit(body)
    if kind == "phone":
        # the sign and first digit of a country code stay; a number without one does not start with 0 or 1
        head = form[:2] if form[0] == "+" else str(2 + s.below(8))
        return head + "".join(str(s.below(10)) for _ in form[len(head) :])
    if kind == "ssn":
        return "".join(str(s.below(10)) for _ in form)
    if kind == "iban":
        return form[:2] + "".join(map(s.like, form[2:]))
    if kind == "key":
        head = 4 if form[:4] in ("AKIA", "ASIA") else form.rfind("_") + 1
        return form[:head] + "".join(map(s.like, form[head:]))
    if kind == "secret":
        # hexadecimal stays hexadecimal
        if re.fullmatch(r"[0-9a-f]+", form):
            return "".join("0123456789abcdef"[s.below(16)] for _ in form)
        return "".join(map(s.like, form))
    return _name(s, kind, form, attempt)


def render(kind: str, raw: str, form: str) -> str:
    """A surrogate's canonical form in the format of the raw entity."""
    if kind in ("card", "phone", "ssn"):
        own = re.sub(r"\D", "", form)
        # a country code that the canonical form leaves out stays as it is
        digits = iter(re.sub(r"\D", "", raw)[: sum(c.isdigit() for c in raw) - len(own)] + own)
        return re.sub(r"\d", lambda _: next(digits), raw)
    if kind == "iban":
        chars = iter(form)
        return re.sub(r"\S", lambda _: next(chars), raw)
    if kind in ("surname", "given_f", "given_m"):
        if raw.isupper():
            return form.upper()
        return "".join(c.upper() if i < len(raw) and raw[i].isupper() else c for i, c in enumerate(form))
    if kind == "email" and raw.isupper():
        return form.upper()
    return form


def entities(docs: DataFrame) -> DataFrame:
    """(kind, form): every distinct entity of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = sorted({s[2:] for t in batch.column("text").to_pylist() for s in find(t)})
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.string()), pa.array([f for _, f in found], pa.string())], ["kind", "form"])

    return docs.select("text").mapInArrow(run, "kind string, form string").distinct()


def exceptions(found: DataFrame, key: str) -> DataFrame:
    """(kind, form, attempt) of the entities whose first surrogate was taken. ``found`` is read often: give a settled table."""

    def hashed(rows: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                made = [surrogate(key, k, f, a) for k, f, a in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.string())], ["kind", "form", "attempt", "made"])

        return rows.mapInArrow(run, "kind string, form string, attempt int, made string")

    rows = settled(hashed(found.withColumn("attempt", F.lit(0))))
    for n in range(ROUNDS):
        # in a clash the entity with the smallest form keeps the surrogate; one that is a real entity nobody keeps
        real = found if n < ROUNDS // 2 else found.limit(0)
        clash = rows.groupBy("kind", "made").agg(F.min("form").alias("first"), F.count("*").alias("n")).where("n > 1").select("kind", "made", "first")
        taken = rows.select("kind", "made").join(real.select("kind", F.col("form").alias("made")), ["kind", "made"], "left_semi").distinct().withColumn("first", F.lit(None).cast("string"))
        bad = clash.unionByName(taken).groupBy("kind", "made").agg(F.count_if(F.col("first").isNull()).alias("real"), F.max("first").alias("first"))
        bad = settled(rows.join(bad, ["kind", "made"]).where((F.col("real") > 0) | (F.col("form") != F.col("first"))).select("kind", "form", "attempt"))
        if bad.isEmpty():
            break
        again = hashed(bad.withColumn("attempt", (F.col("attempt") + 1).cast("int")))
        rows = settled(rows.join(bad, ["kind", "form"], "left_anti").unionByName(again))
    else:
        raise RuntimeError("surrogates still clash: the entities fill the space of their format")
    return rows.where("attempt > 0").select("kind", "form", "attempt")


def key_of(spark: SparkSession) -> str:
    """The configured key, or a new one that nobody else has."""
    return spark.conf.get(KEY_CONF, None) or secrets.token_hex(32)


def replaced(docs: DataFrame, key: str, few: int = FEW) -> DataFrame:
    """``docs`` with the entities of ``text`` replaced and their number as ``n_entities``, which replaces a column of that name."""
    if not key:
        raise ValueError("surrogates need a secret key")
    small_batches(docs.sparkSession)
    docs = docs.drop("n_entities", "_odd", "_key")
    odd = settled(exceptions(settled(entities(docs)), key))
    schema = docs.schema.simpleString()[len("struct<") : -1]

    def apply(batches: Iterator[pa.RecordBatch], attempts: dict | None) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            own = batch.column(batch.schema.get_field_index("_odd")).to_pylist() if attempts is None else None
            texts, counts = [], []
            for i, text in enumerate(batch.column(batch.schema.get_field_index("text")).to_pylist()):
                spans = find(text)
                tries = attempts if own is None else {(x["kind"], x["form"]): x["attempt"] for x in own[i] or ()}
                at, parts = 0, []
                for a, b, kind, form in spans:
                    parts += [text[at:a], render(kind, text[a:b], surrogate(key, kind, form, tries.get((kind, form), 0)))]
                    at = b
                texts.append("".join(parts) + text[at:] if spans else text)
                counts.append(len(spans))
            cols = [pa.array(texts, pa.string()) if n == "text" else c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "_odd"]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(counts, pa.int64())], [*(n for n in batch.schema.names if n != "_odd"), "n_entities"])

    out = f"{schema}, n_entities long"
    if odd.count() <= few:
        known = {(r["kind"], r["form"]): r["attempt"] for r in odd.collect()}
        return docs.mapInArrow(lambda batches: apply(batches, known), out)

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = [(x, s[2], s[3]) for x, t in zip(batch.column("_key").to_pylist(), batch.column("text").to_pylist(), strict=True) for s in find(t)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(3)], ["_key", "kind", "form"])

    # a text with its entities is the key: equal texts have equal exceptions
    keyed = docs.withColumn("_key", F.sha2(F.coalesce("text", F.lit("")), 256))
    hit = keyed.select("_key", "text").mapInArrow(occurrences, "_key string, kind string, form string").distinct().join(odd, ["kind", "form"])
    hit = hit.groupBy("_key").agg(F.collect_list(F.struct("kind", "form", "attempt")).alias("_odd"))
    return keyed.join(settled(hit), "_key", "left").drop("_key").mapInArrow(lambda batches: apply(batches, None), out)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return replaced(docs.select("doc_id", "text"), key_of(spark)).select("doc_id", "n_entities", "text")
