"""Personal data replaced by surrogates of the same type, script, gender and format.

1. One pass finds the entities of every whole text (e-mail, phone, IP address, card and account numbers, national
   ids, secrets, names after a title). An entity's identity is its type and canonical form: digits without
   their separators, e-mail in lower case, a name without its title. All its occurrences get the same surrogate.
   In the text that titles a person, the bare full name, the surname and the titled surname are that person too (of
   several with the same surname the one named last).
2. Every distinct entity draws a surrogate from a keyed hash of its identity: the same number of digits, letters of
   the same script, a name of the title's gender. Draws that two entities share, or that are themselves an entity of
   the corpus, are found by a join over the distinct entities, and all but one owner draw again until none is left.
   Every fourth draw is one sign longer (a name by a syllable), so a short form with few surrogates never runs out.
   So different entities stay different and no surrogate is someone else's real value.
3. The surrogates are written back in each occurrence's own format (separators, capitals). Only documents that have
   entities are shuffled.

Without the key a surrogate cannot be traced to its original; the same key gives the same surrogates again.

Defined cases: null text stays null and has no entities; empty texts and texts without entities are unchanged; rows
that repeat an id and its text get the same result, rows that repeat an id with another text their own; an
empty table gives no rows; very long texts are searched whole; all other columns of the input are kept as they are.
"""

from __future__ import annotations

import bisect
import hashlib
import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwh.llm.common import table, written

KEY = b"demonstration key; production runs pass their own"

# Titles by the gender they state ("" where they state none).
TITLES = {"Mr": "m", "Mister": "m", "Herr": "m", "Herrn": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Sir": "m",
          "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Señora": "f", "Sra": "f",
          "Lady": "f", "Dr": "", "Prof": "", "г-н": "m", "г-жа": "f"}
# Syllables that names are made of, by script; endings by gender.
SYLLABLES = {
    "latin": ["ba", "ber", "da", "del", "el", "fa", "gan", "ha", "jo", "ka", "lan", "li", "ma", "mor", "na", "or",
              "pa", "ra", "ro", "sa", "sel", "ta", "tor", "va", "vin", "wel", "yo", "za"],
    "cyrillic": ["ба", "бе", "ва", "га", "да", "де", "жо", "за", "ка", "ле", "ли", "ма", "ми", "на", "но", "ра",
                 "ро", "са", "се", "та"],
    "greek": ["αν", "βα", "γα", "δη", "ελ", "θε", "κα", "λα", "μα", "νι", "πα", "ρο", "σο", "τα", "φι"],
}
ENDINGS = {"latin": {"m": "o", "f": "a", "": "en"}, "cyrillic": {"m": "ов", "f": "ова", "": "ин"},
           "greek": {"m": "ος", "f": "α", "": "ης"}}

_TITLE = "|".join(sorted(map(re.escape, TITLES), key=len, reverse=True))
_NAME = r"[^\W\d_a-z][^\W\d_]*(?:[-'’][^\W\d_]+)?"
_H, _V4 = r"[0-9A-Fa-f]{1,4}", r"(?:\d{1,3}\.){3}\d{1,3}"
#: Patterns by type, the first one that matches at a place wins; group "v" is what is replaced.
PATTERNS = [
    ("email", r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+"),
    ("secret", r"(?:(?i:api[_-]?key|access[_-]?key|secret|token|password|passwd|pwd|bearer)[\"']?\s*[=:]\s*[\"']?"
               r"(?P<v1>(?=[_\-+/=.~]*[A-Za-z0-9])[A-Za-z0-9_\-+/=.~]{8,}))"),
    ("secret", r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9\-]{20,}"
               r"|xox[abpr]-[A-Za-z0-9\-]{10,}|[0-9a-f]{32,})(?![A-Za-z0-9])"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    ("ipv6", rf"(?<![\w:.])(?=[0-9A-Fa-f]{{0,4}}:)(?=[A-Fa-f:]*\d)(?:(?:{_H}:){{6}}(?:{_V4}|{_H}:{_H})"
             rf"|(?:{_H}(?::{_H}){{0,6}})?::(?:(?:{_H}:){{0,5}}{_V4}|{_H}(?::{_H}){{0,6}})?)(?![\w:]|\.\d)"),
    ("ipv4", r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d)"),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("card", r"(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-]*\d)"),
    ("phone", r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}(?:[ .-]?\d{2,4}){1,2}(?!\d)"
              r"|(?<![\w+])(?:\+|00)\d{1,3}(?:[ .-]?\(0\))?(?:[ .-]?\d{2,4}){2,5}(?!\d)"
              r"|(?<![\w+])(?:\+|00)\d{1,3}[ .-]?\d(?:[ .-]?\d{2,4}){3,5}(?!\d)"
              r"|(?<![\w.-])(?:1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-])"
              # national groups after a trunk zero: 01 23 45 67 89, 030 1234567, 0171 123 45 67
              r"|(?<![\w.,+/-])0[1-9](?:[ .-]\d{2}){4}(?![\w-]|[ .]\d)"
              r"|(?<![\w.,+/-])0[1-9]\d{1,3}(?:[ -]| ?/ ?)(?:\d{5,8}(?:-\d{1,4})?|\d{3,4}(?: \d{2,4}){1,3}"
              r"|\d{2}(?: \d{2}){2,3})(?![\w-]|[ .]\d)"),
    ("person", rf"(?<!\w)(?:{_TITLE})\.?[ ](?P<v2>{_NAME}(?:[ ]{_NAME}){{0,2}})"),
]
_ANY = re.compile("|".join(f"(?P<t{i}>{p})" for i, (_, p) in enumerate(PATTERNS)))
#: A text without any of these holds no entity.
_HINT = re.compile(rf"[0-9@]|(?i:secret|token|passw|pwd|bearer|key)|(?<!\w)(?:{_TITLE})\.?[ ]")


_WORD = re.compile(rf"(?<!\w)(?<!\w-){_NAME}(?!\w)")
_POSSESSIVE = re.compile(r"['’][sS]\Z")


def script_of(text: str) -> str:
    for c in text:
        if c.isalpha():
            name = unicodedata.name(c, "")
            return "cyrillic" if name.startswith("CYRILLIC") else "greek" if name.startswith("GREEK") else "latin"
    return "latin"


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, canonical form) of the entities of a text, in order and without overlaps."""
    if not _HINT.search(text):
        return []
    found = []
    for m in _ANY.finditer(text):
        kind = PATTERNS[int(m.lastgroup[1:]) if m.lastgroup[0] == "t" else
                        next(i for i in range(len(PATTERNS)) if m[f"t{i}"] is not None)][0]
        group = "v1" if m["v1"] is not None else "v2" if m["v2"] is not None else 0
        value = m.group(group)
        if kind == "person":
            value = _POSSESSIVE.sub("", value)
            gender = TITLES[re.match(rf"(?:{_TITLE})", m.group(0)).group(0)]
            canonical = f"{gender}|{script_of(value)}|{value.casefold()}"
        elif kind in ("phone", "card", "ssn"):
            canonical = re.sub(r"\(0\)|\D", "", value)
        elif kind == "iban":
            canonical = value.replace(" ", "")
        elif kind == "ipv6":
            try:
                canonical = ipaddress.IPv6Address(value).packed.hex(":", 2)
            except ValueError:
                continue
        else:
            canonical = value.lower() if kind == "email" else value
        found.append((m.start(group), m.start(group) + len(value), kind, canonical))
    return _with_mentions(text, found) if any(kind == "person" for _, _, kind, _ in found) else found


def _nearest(known: list[tuple[int, str]], at: int) -> str:
    """Of (place, canonical form) in order: the last one up to a place, or else the first."""
    return known[max(bisect.bisect_right(known, at, key=lambda k: k[0]) - 1, 0)][1]


def _with_mentions(text: str, found: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """The entities with titled parts of a name as the whole one's, and with the bare mentions of all persons."""
    whole: dict[tuple[str, str], list[tuple[int, str]]] = {}     # by gender ("*": any) and the name or its surname
    persons = [(a, c) for a, _, kind, c in found if kind == "person"]
    # a name of several words, and of those one with a gender, says who the others are
    for a, c in persons:
        gender, _, name = c.split("|", 2)
        for key in {name, name.rsplit(" ", 1)[-1]} if " " in name else ():
            for g in {gender, "*"}:
                whole.setdefault((g, key), []).append((a, c))
    same: dict[tuple[int, str], str] = {}
    for a, c in persons:
        gender, _, name = c.split("|", 2)
        known = whole.get((gender or "*", name))
        if not gender and known:
            known = [k for k in known if k[1][0] != "|"] or known
        elif gender and " " not in name:
            known = known or whole.get(("", name))
        same[a, c] = c if not known or gender and " " in name else _nearest(known, a)
    found = [(a, b, kind, same.get((a, c), c) if kind == "person" else c) for a, b, kind, c in found]
    names: dict[str, list[tuple[int, str]]] = {}
    for a, _, kind, c in found:
        if kind == "person":
            name = c.split("|", 2)[2]
            for key in {name, name.rsplit(" ", 1)[-1]}:
                if len(key) > 1:
                    names.setdefault(key, []).append((a, c))
    out, end = [], 0
    for span in [*found, (len(text), len(text), "", "")]:
        words = [(m.start(), m.start() + len(w), w.casefold()) for m in _WORD.finditer(text, end, span[0])
                 for w in [_POSSESSIVE.sub("", m.group())]]
        i = 0
        while i < len(words):
            n = 1
            for n in (3, 2, 1):
                if i + n <= len(words) and all(text[words[k][1]:words[k + 1][0]].isspace() for k in range(i, i + n - 1)):
                    known = names.get(" ".join(w for *_, w in words[i:i + n]))
                    if known:
                        out.append((words[i][0], words[i + n - 1][1], "person", _nearest(known, words[i][0])))
                        break
            i += n
        out.append(span)
        end = span[1]
    return out[:-1]


class _Stream:
    """Numbers drawn from a keyed hash of an entity and the number of the attempt."""

    def __init__(self, key: bytes, kind: str, canonical: str, attempt: int):
        self.seed = hmac.new(key, f"{kind}\0{canonical}\0{attempt}".encode(), hashlib.sha256).digest()
        self.value, self.block = int.from_bytes(self.seed, "big"), 0

    def below(self, n: int) -> int:
        if self.value < 1 << 64:
            self.block += 1
            self.value = int.from_bytes(hashlib.sha256(self.seed + self.block.to_bytes(8, "big")).digest(), "big")
        self.value, out = divmod(self.value, n)
        return out


def draw(key: bytes, kind: str, canonical: str, attempt: int) -> str:
    """The surrogate's canonical form: same type, length, character kinds, script and gender.

    Later attempts are longer, by a digit, letter or syllable; only an IPv4 address stays one of 254 ** 4.
    """
    s = _Stream(key, kind, canonical, attempt)
    more = attempt // 4
    if kind == "ipv4":
        return ".".join(str(1 + s.below(254)) for _ in range(4))
    if kind == "ipv6":                                   # zero groups stay, but one more every fourth attempt
        groups, free = [], more
        for g in canonical.split(":"):
            drawn = g != "0000" or free > 0
            free -= g == "0000"
            groups.append(f"{1 + s.below(0xFFFF):04x}" if drawn else g)
        return ":".join(groups)
    if kind == "person":
        gender, script, name = canonical.split("|", 2)
        words = []
        for i, _ in enumerate(name.split()):
            body = "".join(SYLLABLES[script][s.below(len(SYLLABLES[script]))] for _ in range(2 + s.below(2) + more))
            words.append(body + (ENDINGS[script][gender] if i == 0 else ""))
        return f"{gender}|{script}|" + " ".join(words)
    hexadecimal = kind == "secret" and re.fullmatch(r"[0-9a-f]+", canonical)
    # the country stays, and trunk zeros or the 1 before ten digits
    fixed = 2 if kind == "iban" else 0 if kind != "phone" else \
        1 if canonical[0] == "1" and len(canonical) == 11 else len(canonical) - len(canonical.lstrip("0"))
    out = []
    for i, c in enumerate(canonical):
        if i < fixed:
            out.append(c)
        elif hexadecimal:
            out.append("0123456789abcdef"[s.below(16)])
        elif c.isdigit():
            # a first digit stays non-zero
            out.append(str(1 + s.below(9)) if i == 0 or i == fixed and kind == "phone" else str(s.below(10)))
        elif c.isalpha():
            letter = "abcdefghijklmnopqrstuvwxyz"[s.below(26)]
            out.append(letter.upper() if c.isupper() else letter)
        else:
            out.append(c)
    if kind == "email":                                  # a reserved domain, and as many labels as before
        local, _, domain = "".join(out).partition("@")
        labels = domain.split(".")
        local += "".join("abcdefghijklmnopqrstuvwxyz"[s.below(26)] for _ in range(more))
        return f"{local}@" + ".".join(labels[:-2] + ["example", ("com", "net", "org")[s.below(3)]])
    signs = "0123456789abcdef" if hexadecimal else "0123456789"
    return "".join(out) + "".join(signs[s.below(len(signs))] for _ in range(more))


def rendered(original: str, kind: str, surrogate: str) -> str:
    """A surrogate in the format of one occurrence of its original."""
    if kind in ("phone", "card", "ssn", "iban"):
        signs = iter(surrogate)
        return re.sub(r"\(0\)|[^\W_]", lambda c: c[0] if len(c[0]) > 1 else next(signs), original) + "".join(signs)
    if kind == "person":
        words, new = original.split(), surrogate.split("|", 2)[2].split(" ")
        signs = iter(new[-len(words):])                  # a surname alone is the last word
        return re.sub(r"\S+", lambda o: next(signs).upper() if len(o[0]) > 1 and o[0].isupper() else next(signs).capitalize(),
                      original)
    if kind == "ipv6":
        address = ipaddress.IPv6Address(surrogate)
        short = ":".join(f"{int(g, 16):x}" for g in surrogate.split(":"))
        out = address.compressed if "::" in original else surrogate if len(original) == 39 else short
        return out.upper() if re.search("[A-F]", original) else out
    if kind == "email" and original.isupper():
        return surrogate.upper()
    return surrogate


def assign(found: DataFrame, key: bytes) -> DataFrame:
    """(kind, canonical, surrogate) for distinct (kind, canonical): no two alike, none that is itself an entity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            yield batch.append_column("surrogate", pa.array(
                [draw(key, r["kind"], r["canonical"], r["attempt"]) for r in rows], pa.string()))

    real = found.select("kind", F.col("canonical").alias("surrogate")).withColumn("real", F.lit(True))
    now = found.select("kind", "canonical", F.lit(0).alias("attempt"))
    while True:
        drawn = written(now.mapInArrow(run, "kind string, canonical string, attempt int, surrogate string"), "surrogates")
        # of those that share a draw the earliest owner keeps it
        owner = drawn.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "canonical")).alias("owner"))
        checked = (drawn.join(owner, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left")
                   .withColumn("again", F.col("real").isNotNull() | (F.col("owner.canonical") != F.col("canonical"))))
        checked = written(checked.select("kind", "canonical", "attempt", "again"), "surrogate-checks")
        if checked.filter("again").isEmpty():
            return drawn.select("kind", "canonical", "surrogate")
        now = checked.select("kind", "canonical", (F.col("attempt") + F.col("again").cast("int")).alias("attempt"))


_FOUND = "__doc string, __spans array<struct<start:int,stop:int,kind:string,canonical:string>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("kind", pa.string()),
                             ("canonical", pa.string())]))


def replace_entities(docs: DataFrame, key: bytes = KEY, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with surrogates in ``text_col``, plus ``n_entities`` and ``entity_types``."""
    at, schema = docs.columns.index(text_col), docs.schema
    columns = docs.columns

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            spans = [[{"start": a, "stop": b, "kind": k, "canonical": c} for a, b, k, c in entities(t or "")]
                     for t in texts]
            names = [hashlib.sha256((t or "").encode()).hexdigest() if s else None for t, s in zip(texts, spans, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(spans, _SPANS)],
                                             [*columns, "__doc", "__spans"])

    layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    searched = docs.mapInArrow(search, f"{layout}, {_FOUND}")
    # rows with entities are written; the others pass through a second search, which is cheaper than a shuffle
    hit = written(searched.filter("size(__spans) > 0"), "entity-documents")
    calm = searched.filter("size(__spans) = 0").select(
        *[F.col(f"`{c}`") for c in columns], F.lit(0).alias("n_entities"), F.lit("").alias("entity_types"))
    mentions = hit.select("__doc", F.explode("__spans").alias("s")).select("__doc", "s.kind", "s.canonical").distinct()
    distinct = written(mentions.select("kind", "canonical").distinct(), "entities")
    known = assign(distinct, key)
    # the distinct entities of one text
    per_doc = mentions.join(known, ["kind", "canonical"]).groupBy("__doc").agg(F.collect_list(
        F.struct("kind", "canonical", "surrogate")).alias("__known"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, types, n = [], [], []
            of = lambda name: batch.column(batch.schema.get_field_index(name)).to_pylist()  # noqa: E731, B023
            for text, spans, pairs in zip(batch.column(at).to_pylist(), of("__spans"), of("__known"), strict=True):
                table_ = {(p["kind"], p["canonical"]): p["surrogate"] for p in pairs}
                parts, end = [], 0
                for s in spans:
                    new = rendered(text[s["start"]:s["stop"]], s["kind"], table_[s["kind"], s["canonical"]])
                    parts += [text[end:s["start"]], new]
                    end = s["stop"]
                texts.append("".join(parts) + text[end:])
                n.append(len(spans))
                types.append(",".join(sorted({s["kind"] for s in spans})))
            own = [batch.column(i) for i in range(len(columns))]
            own[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*own, pa.array(n, pa.int32()), pa.array(types, pa.string())],
                                             [*columns, "n_entities", "entity_types"])

    changed = hit.join(per_doc, "__doc").select(
        *[F.col(f"`{c}`") for c in columns], "__spans", "__known").mapInArrow(
        apply, f"{layout}, n_entities int, entity_types string")
    return changed.unionByName(calm)


def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_entities(docs)
