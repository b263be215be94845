"""Operator 7: surrogate generation for personal data, JVM-side only.

1. Mentions are found by one regular expression: e-mail addresses, payment card
   and social security numbers, phone numbers, IP addresses, IBANs, access
   tokens and titled person names. Texts without a digit, ``@``, title, the
   beginning of a token or groups of an address are not searched further.
2. A mention is split into parts ``(kind, canon)``: the canonical form ignores
   case and punctuation, so different spellings of one entity share a part. A
   person name gives one part per name; the title tells the gender.
3. Every distinct part gets a surrogate of its kind, drawn by SHA-256 under the
   key: digits for digits, letters of the same script for letters, the same
   length, valid check digits where the original has them, given names of the
   same gender.
   Card, social security and phone numbers are permuted under the key among all
   numbers of their length (a Feistel network), so no two of them meet.
4. Collision check: a surrogate shared by two parts, or equal to a part that is
   in the corpus, is drawn again for all but the first of them, with the next
   attempt number, until none is left.
5. A mention takes its parts' surrogates in its own format and case. Equal
   mentions get equal replacements everywhere (coreference), different entities
   different ones (distinctness).

Only texts that hold a mention are shuffled, and they are keyed by their SHA-256
digest, so repeated rows share their work.

Defined results: null texts stay null; empty texts and texts without a mention
stay as they are; repeated rows give repeated rows; null ids and any further
columns are carried through (``n_chars``, where present, becomes the new
length); an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import checkpointed

# Titles by gender, and the letters surrogate names are made of.
TITLES_F = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Госпожа", "госпожа", "г-жа", "Κυρία"]
TITLES_M = ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "господин", "г-н", "Κύριος"]
TITLES_N = ["Mx", "Dr", "Prof"]
SCRIPTS = {
    "Latin": {"consonants": "bdfgklmnprstv", "vowels": "aeiou", "given_f": "a", "given_m": "o", "given_n": "e", "surname": "en"},
    "Cyrillic": {"consonants": "бвгдзклмнпрст", "vowels": "аеиоу", "given_f": "а", "given_m": "й", "given_n": "е", "surname": "енко"},
    "Greek": {"consonants": "βγδζκλμνπρστφ", "vowels": "αεηιο", "given_f": "α", "given_m": "ος", "given_n": "ι", "surname": "ου"},
}

_WORD = r"\p{L}\p{N}"
_TITLE = "(?:" + "|".join(sorted(TITLES_F + TITLES_M + TITLES_N, key=len, reverse=True)) + r")\.?"
_NAME = r"\p{Lu}[\p{L}'’-]+"
KIND_PATTERNS = {
    "email": rf"(?<![{_WORD}._%+-])[{_WORD}][{_WORD}._%+-]*@[{_WORD}-]+(?:\.[{_WORD}-]+)+",
    "secret": rf"(?<![{_WORD}])(?:[0-9a-f]{{32,}}|[0-9A-F]{{32,}}|AKIA[0-9A-Z]{{16}}|gh[pousr]_[A-Za-z0-9]{{36,}}|sk-[A-Za-z0-9]{{20,}})(?![{_WORD}])",
    "iban": rf"(?<![{_WORD}])[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{3,7}}(?: ?[A-Z0-9]{{1,3}})?(?![{_WORD}])",
    "ip4": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)",
    "ip6": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d-])\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\d-]?\d)",
    "phone": r"(?<![\d+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\d-]?\d)",
    "name": rf"(?<![{_WORD}]){_TITLE} {_NAME}(?: {_NAME}){{0,2}}",
}
MENTION = "|".join(f"(?:{p})" for p in KIND_PATTERNS.values())
#: Cheap test that every text with a mention passes.
HINT = rf"[0-9@]|(?<![{_WORD}]){_TITLE} \p{{Lu}}|[0-9A-Fa-f]{{32}}|AKIA|gh[pousr]_|sk-|[A-Fa-f]:[A-Fa-f]"


def mentions_of(text: Column) -> Column:
    """All mentions of a text, in order; empty for null."""
    found = F.regexp_extract_all(text, F.lit(MENTION), F.lit(0))
    return F.when(text.rlike(HINT), found).otherwise(F.array().cast("array<string>"))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, r"\D", "")


def _kind(mention: Column) -> Column:
    out = F.when(mention.rlike(f"^{_TITLE} "), "name").when(F.contains(mention, F.lit("@")), "email")
    for kind in ("secret", "iban", "ip4", "ip6", "ssn", "phone", "card"):
        out = out.when(mention.rlike(f"^(?:{KIND_PATTERNS[kind]})$"), kind)
    return out.otherwise("card")


def _titled(mention: Column, titles: list[str]) -> Column:
    return F.regexp_replace(F.split(mention, " ")[0], r"\.$", "").isin(titles)


def parts_of(mentions: DataFrame) -> DataFrame:
    """``mention, kind, at, shown, canon`` per part of each distinct mention."""
    kinded = mentions.withColumn("whole", _kind(F.col("mention")))
    shown = F.when(F.col("whole") == "name", F.split("mention", " ")).otherwise(F.array("mention"))
    parts = kinded.withColumn("n", F.size(shown)).select("mention", "whole", "n", F.posexplode(shown).alias("at", "shown"))
    given = (
        F.when(_titled(F.col("mention"), TITLES_F), "given_f")
        .when(_titled(F.col("mention"), TITLES_M), "given_m").otherwise("given_n")
    )
    kind = (
        F.when(F.col("whole") != "name", F.col("whole"))
        .when(F.col("at") == 0, "title").when(F.col("at") == F.col("n") - 1, "surname").otherwise(given)
    )
    parts = parts.withColumn("kind", kind)
    canon = (
        F.when(F.col("kind").isin("ssn", "card"), _digits(F.col("shown")))
        .when(F.col("kind") == "phone", F.right(_digits(F.col("shown")), F.lit(10)))
        .when(F.col("kind") == "iban", F.regexp_replace("shown", " ", ""))
        .when(F.col("kind") == "secret", F.col("shown"))
        .otherwise(F.lower("shown"))
    )
    return parts.select("mention", "kind", "at", "shown", canon.alias("canon"))


def _pick(alphabet: str, draw: Column) -> Column:
    """A letter of ``alphabet`` by a drawn long."""
    return F.substring(F.lit(alphabet), (F.pmod(draw, F.lit(len(alphabet))) + 1).cast("int"), F.lit(1))


def _draw(digest: Column, at: Column) -> Column:
    return F.xxhash64(digest, at.cast("int"))


def _same_shape(canon: Column, digest: Column) -> Column:
    """A string of the same length: digits for digits, letters of the same
    script and case for letters, everything else as it is."""
    def char(at: Column) -> Column:
        c, draw = F.substring(canon, at, F.lit(1)), _draw(digest, at)
        out = F.when(c.rlike(r"\d"), _pick("0123456789", draw))
        for script, values in SCRIPTS.items():
            letters = values["consonants"] + values["vowels"]
            out = out.when(c.rlike(rf"^(?=\p{{Is{script}}})\p{{Lu}}"), _pick(letters.upper(), draw))
            out = out.when(c.rlike(rf"^(?=\p{{Is{script}}})\p{{L}}"), _pick(letters, draw))
        return out.otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(canon))), char), "")


def _luhn_sum(digits: Column) -> Column:
    def add(total: Column, at: Column) -> Column:
        d = F.substring(digits, at, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when((F.length(digits) - at) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


#: Rounds of the permutation of a number space.
FEISTEL_ROUNDS = 8


def _once(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _permuted(digits: Column, key: Column) -> Column:
    """A keyed permutation of all digit strings of one length: a Feistel network of
    two halves (of one digit: a keyed shift). Different strings stay different, so a
    full space needs no second draw."""
    return _once(F.struct(digits.alias("digits"), key.alias("key")), lambda x: _network(x["digits"], x["key"]))


def _network(digits: Column, key: Column) -> Column:
    n = F.length(digits)
    left_size = F.floor(n / 2).cast("int")

    def shifted(half: Column, by: Column, at: Column) -> Column:
        """``half`` plus a hash of ``by``, modulo its space; same length."""
        size = F.length(half)
        space = F.rpad(F.lit("1"), size + 1, F.lit("0")).cast("decimal(38,0)")
        drawn = F.conv(F.substring(F.sha2(F.concat_ws("\x1f", key, at.cast("string"), by), 256), 1, 15), 16, 10).cast("decimal(38,0)")
        moved = (half.cast("decimal(37,0)") + drawn) % space
        return F.lpad(moved.cast("decimal(38,0)").cast("string"), size, F.lit("0"))

    def step(pair: Column, at: Column) -> Column:
        moved = shifted(pair["a"], pair["b"], at)
        return F.struct(pair["b"].alias("a"), moved.alias("b"))

    start = F.struct(F.left(digits, left_size).alias("a"), F.substring(digits, left_size + 1, n).alias("b"))
    done = F.aggregate(F.sequence(F.lit(1), F.lit(FEISTEL_ROUNDS)), start, step)
    return F.when(n > 1, F.concat(done["a"], done["b"])).otherwise(shifted(digits, F.lit(""), F.lit(0)))


def _card(canon: Column, key: Column) -> Column:
    """First digit kept, the inner digits permuted; the last digit is as far from
    the check digit as the original's, so valid numbers stay valid and different
    numbers different."""
    def check(body: Column) -> Column:
        return F.pmod(F.lit(10) - _luhn_sum(F.concat(body, F.lit("0"))) % 10, F.lit(10))

    first, inner = F.left(canon, F.lit(1)), F.substring(canon, F.lit(2), F.length(canon) - 2)
    off = F.right(canon, F.lit(1)).cast("int") - check(F.concat(first, inner))
    body = F.concat(first, _permuted(inner, F.concat_ws("\x1f", key, first)))
    return _once(body, lambda b: F.concat(b, F.pmod(check(b) + off, F.lit(10)).cast("string")))


def _name(kind: Column, canon: Column, digest: Column, attempt: Column) -> Column:
    """Syllables of the same script with the ending of its kind and gender."""
    def made(script: str) -> Column:
        values = SCRIPTS[script]
        syllables = F.transform(
            F.sequence(F.lit(1), F.lit(3) + attempt),
            lambda i: F.concat(_pick(values["consonants"], _draw(digest, i * 2)), _pick(values["vowels"], _draw(digest, i * 2 + 1))),
        )
        ending = F.coalesce(*[F.when(kind == k, v) for k, v in values.items()], F.lit(""))
        return F.concat(F.array_join(syllables, ""), ending)

    return (
        F.when(canon.rlike(r"^\p{IsCyrillic}"), made("Cyrillic"))
        .when(canon.rlike(r"^\p{IsGreek}"), made("Greek")).otherwise(made("Latin"))
    )


def surrogate_of(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a part at one attempt. Later attempts at short free-form
    parts grow longer, so a free one always exists."""
    def digest(*parts: Column) -> Column:
        return F.sha2(F.concat_ws("\x1f", F.lit(key), *parts), 256)

    own = digest(kind, canon, attempt.cast("string"))
    space = digest(kind, F.length(canon).cast("string"), attempt.cast("string"))
    local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    ending = F.concat(F.lit("."), F.substring_index(domain, ".", -1))
    host = F.substring(domain, F.lit(1), F.length(domain) - F.length(ending))
    longer = F.transform(F.sequence(F.lit(0), F.greatest(attempt - 2, F.lit(0))), lambda i: F.when(i > 0, _pick("0123456789", _draw(own, -i))).otherwise(""))
    hexes = F.array_join(F.transform(F.sequence(F.lit(1), F.length(canon)), lambda i: F.when(
        F.substring(canon, i, F.lit(1)) == ":", F.lit(":")).otherwise(_pick("0123456789abcdef", _draw(own, i)))), "")
    octets = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: (F.pmod(_draw(own, i), F.lit(254)) + 1).cast("string")), ".")
    return (
        F.when(kind == "email", F.concat(_same_shape(local, own), F.array_join(longer, ""), F.lit("@"), _same_shape(host, digest(F.lit("host"), host)), ending))
        .when((kind == "secret") & canon.rlike("^[0-9a-f]+$"), hexes)
        .when((kind == "secret") & canon.rlike("^[0-9A-F]+$"), F.upper(hexes))
        .when(kind == "secret", F.concat(F.left(canon, F.lit(4)), _same_shape(F.substring(canon, F.lit(5), F.length(canon)), own)))
        .when(kind == "iban", F.concat(F.left(canon, F.lit(2)), _same_shape(F.substring(canon, F.lit(3), F.length(canon)), own)))
        .when(kind == "ip4", octets).when(kind == "ip6", hexes)
        .when(kind == "card", _card(canon, space))
        .when(kind.isin("ssn", "phone"), _permuted(canon, space))
        .otherwise(_name(kind, canon, own, attempt))
    )


#: From this attempt on a surrogate may equal a part of the corpus (only small,
#: nearly full spaces get that far), never another surrogate.
RELAXED = 12
#: Kinds whose surrogates are a permutation of all numbers of their length. After
#: ``NUMBER_ATTEMPTS`` a space with a clash left takes one permutation as a whole,
#: which has none.
NUMBER_KINDS = ("ssn", "card", "phone")
NUMBER_ATTEMPTS = 3
_WHOLE_SPACE = 1000


def surrogate_table(parts: DataFrame, key: str) -> DataFrame:
    """``kind, canon, surrogate`` with every surrogate of a kind distinct.

    Numbers are settled after ``NUMBER_ATTEMPTS`` rounds at most, however full their
    space is; the free-form surrogates grow with the attempts, so they settle, too.
    """
    def drawn(rows: DataFrame) -> DataFrame:
        return rows.withColumn("surrogate", surrogate_of(F.col("kind"), F.col("canon"), F.col("attempt"), key))

    space = F.regexp_replace("kind", "^given_.*", "given").alias("space")
    number = F.col("kind").isin(*NUMBER_KINDS)
    real = checkpointed(parts.where("kind <> 'title'").select("kind", "canon").distinct())
    now = checkpointed(drawn(real.withColumn("attempt", F.lit(0))))
    while True:
        first = now.groupBy(space, "surrogate").agg(F.count("*").alias("n"), F.min(F.struct("attempt", "kind", "canon")).alias("first"))
        taken = real.select(space, F.col("canon").alias("surrogate")).distinct().withColumn("real", F.lit(True))
        judged = (
            now.withColumn("space", space).join(first.where("n > 1"), ["space", "surrogate"], "left")
            .join(taken, ["space", "surrogate"], "left")
            .withColumn("clash", (F.col("attempt") < _WHOLE_SPACE) & (
                (F.col("real").isNotNull() & (F.col("attempt") < RELAXED))
                | (F.col("n").isNotNull() & (F.struct("attempt", "kind", "canon") != F.col("first")))
            ))
        )
        bad = checkpointed(judged.where("clash").select("kind", "canon", "attempt"))
        if bad.isEmpty():
            return now.select("kind", "canon", "surrogate")
        size = F.length("canon").alias("size")
        # A kind, and a length of its numbers: a few dozen rows.
        full = bad.where(number & (F.col("attempt") + 1 >= NUMBER_ATTEMPTS)).select("kind", size).distinct()
        switched = now.withColumn("size", F.length("canon")).join(full, ["kind", "size"], "left_semi").select("kind", "canon")
        switched = switched.withColumn("attempt", F.lit(_WHOLE_SPACE))
        bad = bad.withColumn("size", F.length("canon")).join(full, ["kind", "size"], "left_anti").select("kind", "canon", "attempt")
        again = drawn(bad.withColumn("attempt", F.col("attempt") + 1).unionByName(switched))
        kept = now.join(again.select("kind", "canon"), ["kind", "canon"], "left_anti")
        now = checkpointed(kept.unionByName(again))


def _in_format(kind: Column, shown: Column, surrogate: Column) -> Column:
    """The surrogate with the punctuation and case of the mention."""
    def number(at: Column) -> Column:
        c = F.substring(shown, at, F.lit(1))
        left_over = F.length(F.regexp_replace(F.substring(shown, at, F.length(shown)), "[^0-9A-Z]", ""))
        place = F.length(surrogate) - left_over + 1
        return F.when(c.rlike("[0-9A-Z]") & (place >= 1), F.substring(surrogate, place, F.lit(1))).otherwise(c)

    def cased(at: Column) -> Column:
        c = F.substring(surrogate, at, F.lit(1))
        return F.when(F.substring(shown, at, F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c)

    each = F.sequence(F.lit(1), F.length(shown))
    named = F.when((F.length(shown) > 1) & (F.upper(shown) == shown), F.upper(surrogate)).otherwise(F.initcap(surrogate))
    return (
        F.when(kind == "title", shown)
        .when(kind.isin("ssn", "card", "phone", "iban"), F.array_join(F.transform(each, number), ""))
        .when(kind.isin("email", "ip6"), F.array_join(F.transform(F.sequence(F.lit(1), F.length(surrogate)), cased), ""))
        .when(kind.isin("secret", "ip4"), surrogate)
        .otherwise(named)
    )


def replacements(mentions: DataFrame, key: str) -> DataFrame:
    """``mention, replacement`` for every distinct mention."""
    parts = checkpointed(parts_of(mentions.select("mention").distinct()))
    made = parts.join(surrogate_table(parts, key), ["kind", "canon"], "left")
    piece = F.struct("at", _in_format(F.col("kind"), F.col("shown"), F.col("surrogate")).alias("s"))
    return made.groupBy("mention").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda p: p["s"]), " ").alias("replacement")
    )


def replace_personal_data(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with every mention replaced; all columns kept, whatever their names.

    ``key`` is the secret under which surrogates are drawn: equal keys give
    equal surrogates over equal corpora.
    """
    # The table's own columns travel as one, so no name of theirs can clash.
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("whole"), docs["text"].alias("text"))
    text = F.col("text")
    holds = F.size(mentions_of(text)) > 0
    found = checkpointed(
        docs.where(holds).select(F.sha2(text, 256).alias("digest"), F.explode(mentions_of(text)).alias("mention")).distinct()
    )
    lists = (
        found.join(replacements(found, key), "mention").groupBy("digest")
        .agg(F.map_from_entries(F.collect_list(F.struct("mention", "replacement"))).alias("made"))
    )
    between = F.split(text, MENTION, -1)
    new = F.array_join(F.concat(
        F.array(between[0]),
        F.zip_with(mentions_of(text), F.slice(between, 2, F.size(between)), lambda m, s: F.concat(F.col("made")[m], s)),
    ), "")
    changed = whole.where(holds).withColumn("digest", F.sha2(text, 256)).join(lists, "digest").select("whole", new.alias("new"))
    written = {"text": F.col("new")}
    if "n_chars" in docs.columns:
        written["n_chars"] = F.length("new").cast(docs.schema["n_chars"].dataType)
    changed = changed.select(*[written.get(c, F.col("whole")[c]).alias(c) for c in docs.columns])
    return docs.where(~holds | text.isNull()).unionByName(changed)
