"""Personal data replaced by surrogates of the same type, script and format.

Detected entities get keyed replacements that look alike: digits stay digits,
letters keep case and script, separators stay. For all kinds but names the
replacement is a keyed permutation of all strings of that shape, so different
entities cannot meet; check digits are made anew. Names are drawn, by key, from
names of the same gender and script.

The same entity gets the same surrogate in every document (coreference; case
and blanks do not matter). The parts of a name, given and family, are entities
of their own with an attempt of their own, so a part is replaced alike wherever
it stands, also after a collision of another part. A name of one part is a
family name. A collision check over the distinct entities of the whole corpus finds
surrogates that two entities share, or that are themselves an entity of the
corpus; all but the smallest of those entities try again with the next
attempt until none is left. Given names of both genders share one check, family
names after any title another, so different names stay different as a whole. A
given name's surrogate may be a given name of the corpus, as its family name
is not one of it. Names grow by a syllable every second
attempt, so they cannot run out; the other kinds keep their format, so a
corpus that holds nearly all strings of one format is an error. Only entities past their first attempt are joined
back to the documents that hold them.

Defined cases: a null text stays null; texts without entities come back as
they are; very long texts are searched whole; overlapping finds: the longer, then the earlier kind in KINDS;
repeated rows are treated alike; an empty table gives no rows; other columns
are not touched.
"""

from __future__ import annotations

import hmac
import re
from bisect import bisect
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.llm.common import digest_of, key_of
from tidings.session import written

# Patterns of the kinds, and a test that spares texts which cannot hold one.
_TITLES = {"m": r"Mr|Herr|Herrn|Señor|Sr|Monsieur|господин", "f": r"Mrs|Ms|Miss|Frau|Señora|Sra|Madame|Mme|госпожа"}
_CAP = r"[A-ZÀ-ÖØ-ÞА-ЯЁ][a-zà-öø-ÿа-яё'’-]+"
KINDS: dict[str, str] = {
    "email": r"(?<![\w.+-])[\w.+%-]{1,64}@(?:[\w-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![\w-])",
    "secret": r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,64}|[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "mac": r"(?<![\w:])(?:[0-9A-Fa-f]{2}:){5}[0-9A-Fa-f]{2}(?![\w:])",
    "ipv4": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)",
    "card": r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w]|[-.]\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?![\w]|[-.]\d)|(?<![\w.])\+\d{8,15}(?!\w)",
    "name_m": rf"(?<!\w)(?:{_TITLES['m']})\.? ({_CAP}(?: {_CAP})?)",
    "name_f": rf"(?<!\w)(?:{_TITLES['f']})\.? ({_CAP}(?: {_CAP})?)",
}
_FIND = {kind: re.compile(pattern) for kind, pattern in KINDS.items()}
_TITLE = re.compile("|".join(_TITLES.values()))
_DIGITS = re.compile(r"\d[\d .()-]{5}")
_HEX = re.compile(r"[0-9A-Fa-f:]{16}|AKIA|gh[pousr]_|sk-|[A-Z]{2}\d\d")

# Names by gender and script.
NAMES = {
    ("m", "latin"): "Adam Anton Bruno Carl Daniel David Emil Felix Georg Hugo Ivan Jonas Karl Leo Luis Marco Nils Oscar Paul Rafael Simon Theo Victor Walter".split(),
    ("f", "latin"): "Ada Alma Anna Clara Diana Elena Emma Eva Flora Greta Helena Ida Julia Klara Laura Lena Maria Nora Olga Paula Rosa Sara Tina Vera".split(),
    ("m", "cyrillic"): "Андрей Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Никита Олег Павел Роман Сергей Юрий".split(),
    ("f", "cyrillic"): "Алла Анна Вера Галина Дарья Елена Зоя Ирина Лариса Мария Нина Ольга Полина Раиса Софья Юлия".split(),
}
SYLLABLES = {"latin": "ba ber da den fa gel ha hol ka kel la lin ma mer na nor pa ran sa ten va wel".split(),
             "cyrillic": "ба бер ва гор да дон за ка кол ла мин на ров са тар фе хо".split()}
ENDINGS = {"latin": ("er", "man", "sen", "feld"), "cyrillic": ("ов", "ин", "ский")}

_RANGES = [("0", "9"), ("a", "z"), ("A", "Z"), ("à", "ö"), ("ø", "þ"), ("À", "Ö"), ("Ø", "Þ"), ("а", "я"), ("А", "Я"),
           ("α", "ω"), ("Α", "Ω"), ("一", "鿿"), ("가", "힣"), ("ぁ", "ゖ"), ("ァ", "ヺ")]
_HEXLOWER, _HEXUPPER = "0123456789abcdef", "0123456789ABCDEF"


def _draw(key: bytes, *parts: object) -> int:
    return int.from_bytes(hmac.digest(key, "\x1f".join(map(str, parts)).encode(), "sha256"), "big")


@lru_cache(maxsize=4096)
def _alphabet(c: str) -> tuple[int, int] | None:
    """First code and size of the range a character is replaced within."""
    for lo, hi in _RANGES:
        if lo <= c <= hi:
            return ord(lo), ord(hi) - ord(lo) + 1
    return None


def _shuffle(key: bytes, tweak: str, digits: list[int], radix: list[int]) -> list[int]:
    """A keyed permutation of the strings with these radices: two halves take
    turns in being shifted by a keyed function of the other."""
    half = len(digits) // 2
    sizes = [1, 1]
    value = [0, 0]
    for i, (d, r) in enumerate(zip(digits, radix)):
        side = i >= half
        value[side], sizes[side] = value[side] * r + d, sizes[side] * r
    for turn in range(8):
        side = turn % 2
        value[side] = (value[side] + _draw(key, tweak, turn, value[1 - side])) % sizes[side]
    out = []
    for side, part in ((1, radix[half:]), (0, radix[:half])):
        v = value[side]
        for r in reversed(part):
            out.append(v % r)
            v //= r
    return out[::-1]


def permute(key: bytes, tweak: str, text: str, alphabet: str | None = None) -> str:
    """``text`` with its digits and letters permuted within their ranges (or
    within ``alphabet``); all other characters stay."""
    places, digits, radix, shape = [], [], [], list(text)
    for i, c in enumerate(text):
        if alphabet is not None:
            if c in alphabet:
                places.append((i, None))
                digits.append(alphabet.index(c))
                radix.append(len(alphabet))
                shape[i] = "\x00"
        elif (found := _alphabet(c)) is not None:
            places.append((i, found[0]))
            digits.append(ord(c) - found[0])
            radix.append(found[1])
            shape[i] = f"\x00{found[0]}"
    out = list(text)
    for (i, first), d in zip(places, _shuffle(key, tweak + "".join(shape), digits, radix)):
        out[i] = alphabet[d] if first is None else chr(first + d)
    return "".join(out)


def luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10


def _iban(text: str) -> str:
    """Check digits of an IBAN made anew."""
    moved = text[4:] + text[:2] + "00"
    return f"{text[:2]}{98 - int(''.join(str(int(c, 36)) for c in moved)) % 97:02d}{text[4:]}"


def normal(kind: str, text: str) -> str:
    """What makes two mentions the same entity."""
    if kind in ("email", "mac", "secret"):
        return text.lower()
    if kind in ("card", "iban", "ssn"):
        return re.sub("[ -]", "", text)
    if kind == "phone":
        return re.sub(r"[^\d+]", "", text)
    return text


def script(name: str) -> str:
    return "cyrillic" if re.search("[А-Яа-яЁё]", name) else "latin"


# Kinds of a name's parts.
GIVEN, FAMILY = ("given_m", "given_f"), "family"


def parts_of(kind: str, text: str) -> list[tuple[str, str]]:
    """(kind, normal form) of what a mention consists of."""
    if not kind.startswith("name"):
        return [(kind, normal(kind, text))]
    *given, family = text.split(" ")
    return [(f"given_{kind[-1]}", part) for part in given] + [(FAMILY, family)]


def _name(key: bytes, kind: str, part: str, attempt: int) -> str:
    """A given name by gender and script, or a family name by script; longer
    with the attempts, so that there are names for any corpus."""
    of = script(part)
    n = _draw(key, kind, part, attempt)
    word, ending, syllables = "", ENDINGS[of], 3
    if kind in GIVEN:
        given = NAMES[(kind[-1], of)]
        n, k = divmod(n, len(given))
        word, ending, syllables = given[k], ("",), 0
    for _ in range(syllables + attempt // 2):
        n, k = divmod(n, len(SYLLABLES[of]))
        word += SYLLABLES[of][k]
    return (word + ending[n % len(ending)]).capitalize()


def surrogate(key: bytes, kind: str, entity: str, attempt: int = 0) -> str:
    """The surrogate of a normal form."""
    tweak = f"{kind}/{attempt}/"
    if kind in (*GIVEN, FAMILY):
        return _name(key, kind, entity, attempt)
    if kind == "email":
        local, _, domain = entity.rpartition("@")
        labels, _, top = domain.rpartition(".")
        return f"{permute(key, tweak + top, f'{local}@{labels}')}.{top}"
    if kind in ("mac", "secret"):
        whole = entity if kind == "mac" or re.fullmatch("[0-9a-f]+", entity) else None
        return permute(key, tweak, entity, _HEXLOWER if whole else None) if whole else _token(key, tweak, entity)
    if kind == "ipv4":
        a = [int(x) for x in entity.split(".")]
        return ".".join(map(str, _shuffle(key, tweak, a, [256] * 4)))
    if kind == "iban":
        new = entity[:2] + "00" + permute(key, tweak + entity[:2], entity[4:])
        return _iban(new) if _iban(entity) == entity else new[:2] + permute(key, tweak + "x", entity[2:])
    if kind == "card":
        if luhn(entity) == 0:
            body = permute(key, tweak, entity[:-1])
            return body + str((10 - luhn(body + "0")) % 10)
        new = permute(key, tweak, entity)
        while luhn(new) == 0:  # walks on within the numbers that are no cards
            new = permute(key, tweak, new)
        return new
    if kind == "phone" and entity.startswith("+"):
        # The country code stays.
        return entity[:2] + permute(key, tweak + entity[:2], entity[2:])
    return permute(key, tweak, entity)


def _token(key: bytes, tweak: str, entity: str) -> str:
    head = next(p for p in ("akia", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-") if entity.startswith(p))
    return head + permute(key, tweak + head, entity[len(head):])


def shaped(kind: str, text: str, new: str) -> str:
    """The surrogate in the mention's own format: its separators and case."""
    if kind in ("card", "iban", "ssn", "phone"):
        rest = iter(new)
        keep = " -" if kind != "phone" else " .()-"
        return "".join(c if c in keep else next(rest) for c in text)
    if kind in ("email", "mac", "secret"):
        return "".join(b.upper() if a.isupper() and len(b.upper()) == 1 else b for a, b in zip(text, new)) if len(text) == len(new) else new
    return new


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the entities of a text, in order, not overlapping."""
    kinds = []
    if "@" in text:
        kinds.append("email")
    if _HEX.search(text):
        kinds += ["secret", "iban", "mac"]
    if _DIGITS.search(text):
        kinds += ["ipv4", "card", "ssn", "phone"]
    if _TITLE.search(text):
        kinds += ["name_m", "name_f"]
    found = []
    for rank, kind in enumerate(kinds):
        for m in _FIND[kind].finditer(text):
            group = 1 if kind.startswith("name") else 0
            found.append((m.start(group), m.end(group), rank, kind))
    out: list[tuple[int, int, str]] = []
    taken: list[tuple[int, int]] = []
    if len(found) == 1:
        return [(found[0][0], found[0][1], found[0][3])]
    # By length, so that a short find never splits a long one; then a sweep.
    for start, end, _, kind in sorted(found, key=lambda f: (f[0] - f[1], f[2], f[0])):
        i = bisect(taken, (start, end))
        if (i == 0 or taken[i - 1][1] <= start) and (i == len(taken) or taken[i][0] >= end):
            taken.insert(i, (start, end))
            out.append((start, end, kind))
    return sorted(out)


def replace(text: str, key: bytes, attempts: dict[tuple[str, str], int]) -> tuple[str, list[dict]]:
    """The text with surrogates, and what was replaced where (in the new text)."""
    spans = find(text)
    if not spans:
        return text, []
    out, found, at, size = [], [], 0, 0
    for start, end, kind in spans:
        parts = [surrogate(key, k, e, attempts.get((k, e), 0)) for k, e in parts_of(kind, text[start:end])]
        new = shaped(kind, text[start:end], " ".join(parts))
        out += [text[at:start], new]
        size += start - at
        found.append({"kind": kind, "start": size, "length": len(new)})
        size, at = size + len(new), end
    return "".join([*out, text[at:]]), found


def _mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, kinds, entities = [], [], []
        for i, text in enumerate(batch.column("text")):
            text = text.as_py()
            for kind, entity in sorted({e for a, b, k in find(text) for e in parts_of(k, text[a:b])} if text else ()):
                rows.append(i)
                kinds.append(kind)
                entities.append(entity)
        take = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("key").take(take), batch.column("digest").take(take),
                                          pa.array(kinds, pa.string()), pa.array(entities, pa.string())],
                                         names=["key", "digest", "kind", "entity"])


def _drawn(key: bytes) -> Column:
    @F.pandas_udf("string")
    def run(kind: pd.Series, entity: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(key, k, e, a) for k, e, a in zip(kind, entity, attempt)], dtype=object)
    return run.asNondeterministic()("kind", "entity", "attempt")


def resolve(mentions: DataFrame, key: bytes, rounds: int = 50) -> DataFrame:
    """(kind, entity, attempt, surrogate) of every distinct entity, without
    collisions. Names go on until none is left; of kinds that keep their format,
    none may need more than ``rounds`` attempts."""
    start = mentions.select("kind", "entity").distinct().withColumn("attempt", F.lit(0))
    now = written(start.withColumn("surrogate", _drawn(key)), "entities")
    given = F.col("kind").isin(*GIVEN)
    pool = F.when(given, F.lit("given")).otherwise(F.col("kind")).alias("pool")
    while True:
        # One of those that share a surrogate keeps it.
        shared = now.groupBy(pool, "surrogate").agg(F.min(F.struct("kind", "entity")).alias("first"), F.count("*").alias("n")).where("n > 1")
        lost = now.withColumn("pool", pool).join(shared.drop("n"), ["pool", "surrogate"]).where(F.struct("kind", "entity") != F.col("first"))
        real = now.where(~given).join(now.select("kind", F.col("entity").alias("surrogate")), ["kind", "surrogate"], "left_semi")
        again = written(lost.select("kind", "entity").unionByName(real.select("kind", "entity")).distinct(), "collisions")
        if again.isEmpty():
            return now
        spent = now.where((F.col("attempt") >= rounds) & ~F.col("kind").isin(*GIVEN, FAMILY)).join(again, ["kind", "entity"], "left_semi")
        if not spent.isEmpty():
            raise ValueError("the corpus holds nearly all strings of some format, so that no surrogates are left")
        kept = now.join(again, ["kind", "entity"], "left_anti")
        more = now.join(again, ["kind", "entity"], "left_semi").select("kind", "entity", (F.col("attempt") + 1).alias("attempt"))
        now = written(kept.unionByName(more.withColumn("surrogate", _drawn(key)).select(kept.columns)), "entities")


# Documents with an entity past its first attempt are broadcast up to this many.
SMALL = 10_000
_LATER = "array<struct<kind:string,entity:string,attempt:int>>"


def _replaced(key: bytes) -> Column:
    kind = T.StructType([T.StructField("text", T.StringType()), T.StructField("found", T.ArrayType(T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("length", T.IntegerType())])))])

    @F.pandas_udf(kind)
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, later in batches:
            out = []
            for text, some in zip(texts, later):
                attempts = {} if some is None else {(x["kind"], x["entity"]): x["attempt"] for x in some}
                out.append((None, []) if text is None else replace(text, key, attempts))
            yield pd.DataFrame({"text": [a for a, _ in out], "found": [b for _, b in out]})
    return run.asNondeterministic()("text", "_llm_later")


def pseudonymise(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text with surrogates, entities (kind, start, length in the new
    text) and their number, for every document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    keyed = {"key": key_of("doc_id"), "digest": digest_of("text")}
    mentions = written(rows.withColumns(keyed).select("key", "digest", "text").mapInArrow(
        _mentions, "key long, digest binary, kind string, entity string"), "mentions")
    later = resolve(mentions, key).where("attempt > 0").select("kind", "entity", "attempt")
    held = mentions.distinct().join(later, ["kind", "entity"]).groupBy("key", "digest").agg(
        F.collect_list(F.struct("kind", "entity", "attempt")).alias("_llm_later"))
    held = written(held, "later")
    count = held.limit(SMALL + 1).count()
    if count == 0:
        joined = rows.withColumn("_llm_later", F.lit(None).cast(_LATER))
    else:
        joined = rows.withColumns(keyed).join(F.broadcast(held) if count <= SMALL else held, ["key", "digest"], "left")
    out = joined.select("doc_id", _replaced(key).alias("r"))
    return out.select("doc_id", F.col("r.text").alias("text"), F.col("r.found").alias("entities"),
                      F.size("r.found").alias("n_entities"))
