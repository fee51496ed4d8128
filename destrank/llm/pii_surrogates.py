"""Surrogates for personal data: DataFrame functions only.

Detected entities (e-mail, IPv4 and IPv6 addresses, phone numbers, payment
cards that pass the Luhn check, social security numbers, secrets after a key
word, names after a form of address, and these family and full names anywhere
in the same text) are replaced by surrogates of the same type: digits
for digits in the same format, names of the same gender and script, valid
check digits. A surrogate is drawn from a keyed hash of the normalised entity,
so an entity has one surrogate wherever it occurs (coreference; a family name
keeps it with and without the given name). Draws are checked over the whole
corpus: a surrogate that two entities share, or that is itself an entity of
the corpus, is drawn again, so distinct entities stay distinct.

Cards are looked for at every digit group of a run of digits, before the other
types: a number beside a card does not hide it, and what is not a card is
searched for the other types. A card is made of whole groups, so no card is
read out of the middle of a longer unbroken number.

Texts without an entity never move. The others are cut at their entities once
per distinct text; the distinct entities are one grouped table; pieces are
joined to it by entity and put together again by text digest.

Defined cases: null and empty texts stay as they are; the same text always
becomes the same text; rows that repeat, null ids and other columns, whatever
their names, are passed on; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_name, saved, table, text_key

# Forms of address by the gender they tell.
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία")
OTHER = ("Dr", "Prof", "Доктор")
# Consonants and vowels of surrogate names by script, and their endings (male, female, other, family).
SCRIPTS = {
    "cyrillic": (r"\p{IsCyrillic}", "бвгдзклмнпрстф", "аеиоу", ("н", "на", "р", "ов")),
    "greek": (r"\p{IsGreek}", "βγδζκλμνπρστφχ", "αεηιου", ("ος", "α", "ι", "ης")),
    "latin": (r".", "bdfgklmnprstvz", "aeiou", ("n", "na", "r", "son")),
}

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
EMAIL = r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+"
IP4 = rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9])(?!\.[0-9])"
_HEX = "[0-9A-Fa-f]{1,4}"
#: Eight groups, or fewer with one double colon; a digit is in it, so words joined by colons are none.
IP6 = (
    rf"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f]{{0,4}}:)(?=[0-9A-Fa-f:]*[0-9])(?:{_HEX}(?::{_HEX}){{7}}"
    rf"|(?:{_HEX}(?::{_HEX}){{0,6}})?::(?:{_HEX}(?::{_HEX}){{0,6}})?)(?![0-9A-Za-z:])(?!\.[0-9])"
)
IP = f"{IP4}|{IP6}"
SSN = r"(?<![0-9A-Za-z\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z\-])"
CARD = r"(?<![0-9A-Za-z])[0-9](?:[ \-]?[0-9]){12,18}(?![0-9A-Za-z])"
#: A run of at least 13 digits in whole groups, in which cards are looked for.
RUN = r"(?<![0-9A-Za-z+])(?=[0-9](?:[ \-]?[0-9]){12})[0-9]++(?![A-Za-z])(?:[ \-][0-9]++(?![A-Za-z]))*+"
PHONE = (
    r"\+[0-9]{1,3}[ .\-]?\(?[0-9]{2,4}\)?(?:[ .\-][0-9]{2,4}){1,4}(?![0-9])"
    r"|(?<![0-9A-Za-z])\(?[0-9]{3}\)?[ .\-][0-9]{3}[ .\-][0-9]{4}(?![0-9])"
    r"|(?<![0-9A-Za-z])\([0-9]{3}\)[ .\-]?[0-9]{3}[ .\-]?[0-9]{4}(?![0-9])"
    r"|\+[0-9]{7,15}(?![0-9])"
    r"|\+[0-9]{1,3}[ .\-](?:\(?[0-9]{1,4}\)?[ .\-]?){0,2}[0-9]{5,12}(?![0-9])"
    r"|\+[0-9](?:[ .\-]?\(?[0-9]\)?){6,14}(?![0-9])"
)
#: The country code of a phone number: what stands apart, or by the code's first digits.
COUNTRY = r"^(\+(?:[0-9]{1,3}(?![0-9])|[17]|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}))"
SECRET = r"(?i:token|secret|password|api_?key)\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9_\-+/]{8,}"
PERSON = rf"(?<!\p{{L}})(?:{'|'.join(MALE + FEMALE + OTHER)})\.? \p{{Lu}}\p{{Ll}}+(?: \p{{Lu}}\p{{Ll}}+){{0,2}}"
#: Usual groupings of a card; other groupings count unless they cut a phone or social security number.
CARD_LAYOUT = r"^(?:[0-9]+|[0-9]{4}([ \-])(?:[0-9]{4}\1){2}[0-9]{1,4}(?:\1[0-9]{1,3})?|[0-9]{4}([ \-])[0-9]{6}\2[0-9]{4,5})$"
#: What a run of digits is cut out of; what is looked for outside cards.
NUMBERS = "|".join((IP, SSN, CARD, RUN, PHONE))
AROUND_CARDS = "|".join((EMAIL, IP, SSN, RUN, SECRET))
OTHER_THAN_CARDS = "|".join((EMAIL, IP, SSN, PHONE, SECRET, PERSON))

#: Characters that every secret has one of, and every name's form of address.
SECRET_SIGNS, ADDRESSES = ("=", ":"), MALE + FEMALE + OTHER

ROUNDS = 64
DEFAULT_KEY = "surrogate-key-1"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn_sum(digits: Column) -> Column:
    """The Luhn sum; the last digit counts once, the one before it twice."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.when(d.cast("int") > 4, 2 * d.cast("int") - 9).otherwise(2 * d.cast("int"))))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))


def _token(kind: str | Column, gender: str | Column, value: Column) -> Column:
    kind, gender = (F.lit(c) if isinstance(c, str) else c for c in (kind, gender))
    return F.struct(kind.alias("kind"), gender.alias("gender"), value.alias("value"))


def _tokens(entity: Column) -> Column:
    """An entity as tokens; kind '' is literal text."""
    words = F.split(entity, " ")
    title = F.regexp_replace(F.get(words, F.lit(0)), r"\.$", "")
    gender = F.when(title.isin(*MALE), "m").when(title.isin(*FEMALE), "f").otherwise("u")
    names = F.flatten(F.transform(F.slice(words, 2, F.size(words)), lambda w, i: F.array(
        _token("", "", F.lit(" ")),
        _token(F.when(i == F.size(words) - 2, "family").otherwise("given"), F.when(i == F.size(words) - 2, "").otherwise(gender), w),
    )))
    person = F.concat(F.array(_token("", "", F.get(words, F.lit(0)))), names)
    value = F.regexp_extract(entity, r"([A-Za-z0-9_\-+/]+)$", 1)
    secret = F.array(_token("", "", F.substring(entity, F.lit(1), F.length(entity) - F.length(value))), _token("secret", "", value))

    def single(kind: str) -> Column:
        return F.array(_token(kind, "", entity))

    def whole(pattern: str) -> Column:
        return entity.rlike(f"^(?:{pattern})$")

    return (
        F.when(entity.contains("@"), single("email")).when(whole(IP4), single("ip")).when(whole(IP6), single("ip6")).when(whole(SSN), single("ssn"))
        .when(whole(PHONE), single("phone")).when(whole(SECRET), secret).otherwise(person)
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _cut(text: Column, pattern: str | Column, tokens: Callable[[Column], Column]) -> Column:
    """The text as literal tokens and the tokens of the pattern's matches, in order."""
    found = F.regexp_extract_all(text, F.lit(pattern) if isinstance(pattern, str) else pattern, F.lit(0))
    between = F.split(text, pattern, -1)
    return _let(found, lambda e: F.flatten(F.transform(between, lambda b, i: F.when(
        i < F.size(e), F.concat(F.array(_token("", "", b)), tokens(F.get(e, i)))).otherwise(F.array(_token("", "", b))))))


def _cards(run: Column) -> Column:
    """The cards of a run of digits as (start, stop), in order: whole groups of
    13 to 19 digits that pass the Luhn check; usual layouts go first, of these
    the longest, then the first. Others must not cut a number of 3-3-4 or 3-2-4."""
    at = F.filter(F.sequence(F.lit(1), F.length(run)), lambda p: F.substring(run, p, F.lit(1)).rlike("[0-9]") & ~F.substring(run, p - 1, F.least(p - 1, F.lit(1))).rlike("[0-9]"))
    sizes = [(n, rf"^[0-9](?:[ \-]?[0-9]){{{n - 1}}}(?![0-9])") for n in range(19, 12, -1)]

    def cuts(at: Column) -> Column:
        """Whether a phone or social security number stands across the group start ``at``."""
        before = F.substring(run, F.greatest(at - 9, F.lit(1)), at - F.greatest(at - 9, F.lit(1)))
        after = F.substring(run, at, F.lit(9))
        return (before.rlike("(?<![0-9])[0-9]{3}[ -]$") & after.rlike("^[0-9]{2,3}[ -][0-9]{4}(?![0-9])")) | (
            before.rlike("(?<![0-9])[0-9]{3}[ -][0-9]{2,3}[ -]$") & after.rlike("^[0-9]{4}(?![0-9])"))

    def from_start(p: Column) -> Column:
        rest = F.substring(run, p, F.lit(38))
        found = F.array(*[_let(F.regexp_extract(rest, pattern, 0), lambda v, n=n: F.struct(F.lit(-n).alias("size"), p.alias("start"), (p + F.length(v)).alias("stop"), v.alias("value"))) for n, pattern in sizes])
        valid = F.filter(found, lambda c: (c["value"] != "") & (_luhn_sum(_digits(c["value"])) % 10 == 0))
        return F.filter(valid, lambda c: c["value"].rlike(CARD_LAYOUT) | ~(cuts(c["start"]) | cuts(c["stop"] + 1)))

    valid = F.sort_array(F.transform(F.flatten(F.transform(at, from_start)), lambda c: F.struct(
        (~c["value"].rlike(CARD_LAYOUT)).alias("unusual"), c["size"], c["start"], c["stop"])))
    none = F.array().cast("array<struct<start:int,stop:int>>")
    chosen = F.aggregate(valid, none, lambda done, c: F.when(
        F.exists(done, lambda d: (d["start"] < c["stop"]) & (c["start"] < d["stop"])), done
    ).otherwise(F.concat(done, F.array(F.struct(c["start"].alias("start"), c["stop"].alias("stop"))))))
    return F.sort_array(chosen)


def _run_tokens(run: Column) -> Column:
    """A run of digits as card tokens and the literal text around them."""

    def tokens(cards: Column) -> Column:
        def with_text_before(c: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(cards, i - 1)["stop"]).otherwise(F.lit(1))
            return F.array(_token("", "", F.substring(run, before, c["start"] - before)), _token("card", "", F.substring(run, c["start"], c["stop"] - c["start"])))

        last = F.coalesce(F.get(cards, F.size(cards) - 1)["stop"], F.lit(1))
        return F.concat(F.flatten(F.transform(cards, with_text_before)), F.array(_token("", "", F.substring(run, last, F.length(run)))))

    return _let(_cards(run), tokens)


def _named_again(tokens: Column) -> Column:
    """The tokens with the family and full names found in them also found where
    they stand without a form of address."""
    names = F.filter(tokens, lambda t: t["kind"].isin("given", "family"))

    def of(kind: str, known: Column) -> Column:
        return F.array_join(F.array_distinct(F.transform(F.filter(known, lambda t: t["kind"] == kind), lambda t: t["value"])), "|")

    def again(known: Column) -> Column:
        given = F.when(of("given", known) != "", F.concat(F.lit("(?:(?:"), of("given", known), F.lit(") )*"))).otherwise(F.lit(""))
        pattern = F.concat(F.lit(r"(?<!\p{L})"), given, F.lit("(?:"), of("family", known), F.lit(r")(?!\p{L})"))

        def mention(found: Column) -> Column:
            words = F.split(found, " ")

            def word(w: Column, i: Column) -> Column:
                first = F.get(F.filter(known, lambda t: (t["kind"] == "given") & (t["value"] == w)), F.lit(0))
                name = F.when(i == F.size(words) - 1, _token("family", "", w)).otherwise(first)
                return F.when(i > 0, F.array(_token("", "", F.lit(" ")), name)).otherwise(F.array(name))

            return F.flatten(F.transform(words, word))

        return _let(pattern, lambda p: F.flatten(F.transform(tokens, lambda t: F.when(t["kind"] == "", _cut(t["value"], p, mention)).otherwise(F.array(t)))))

    return F.when(F.size(names) > 0, _let(names, again)).otherwise(tokens)


def _pieces(text: Column) -> Column:
    """All tokens of the text."""
    return _let(_found(text), _named_again)


def _found(text: Column) -> Column:
    """The text as literal and entity tokens, in order: cut at its cards, the
    whole text between two cards is searched for the other types."""

    def others(part: Column) -> Column:
        return _cut(part, OTHER_THAN_CARDS, _tokens)

    def around(tokens: Column) -> Column:
        cards = F.filter(F.transform(tokens, lambda t, i: F.when(t["kind"] == "card", i)), lambda i: i.isNotNull())
        ends = F.concat(F.array(F.lit(-1)), cards, F.array(F.size(tokens)))

        def part(ends: Column) -> Column:
            def after(end: Column, k: Column) -> Column:
                own = F.slice(tokens, end + 2, F.get(ends, k + 1) - end - 1)
                card = F.when(k > 0, F.array(F.get(tokens, end))).otherwise(F.slice(tokens, 1, 0))
                return F.concat(card, others(F.array_join(F.transform(own, lambda t: t["value"]), "")))

            return F.flatten(F.transform(F.slice(ends, 1, F.size(ends) - 1), after))

        return _let(ends, part)

    def run_or_other(found: Column) -> Column:
        return F.when(found.rlike(f"^(?:{RUN})$"), _run_tokens(found)).otherwise(F.array(_token("", "", found)))

    return F.when(text.rlike(RUN), _let(_cut(text, AROUND_CARDS, run_or_other), around)).otherwise(others(text))


def _normal(kind: Column, value: Column) -> Column:
    """What mentions of one entity have in common."""
    return F.when(kind.isin("card", "ssn"), _digits(value)).when(
        kind == "phone", F.concat(F.regexp_extract(value, COUNTRY, 1), F.lit("|"), _digits(F.regexp_replace(value, COUNTRY, "")))
    ).when(kind == "secret", value).otherwise(F.lower(value))


def _drawn(kind: Column, gender: Column, norm: Column, key: str, attempt: int) -> Column:
    """The surrogate of a normalised entity, of the same shape."""
    first = F.sha2(F.concat_ws("|", F.lit(key), kind, gender, norm, F.lit(str(attempt))), 256)
    hexes = F.concat(first, F.sha2(first, 256))
    digits = F.translate(hexes, "abcdef", "012345")
    letters = F.translate(hexes, "0123456789abcdef", "bcdfghjklmnprstv")

    def at(source: Column, i: Column) -> Column:
        return F.substring(source, i % 128 + 1, F.lit(1))

    def like(value: Column) -> Column:
        chars = F.transform(F.split(value, ""), lambda c, i: F.when(c.rlike("[0-9]"), at(digits, i))
                            .when(c.rlike("[a-z]"), at(letters, i)).when(c.rlike("[A-Z]"), F.upper(at(letters, i))).otherwise(c))
        return F.array_join(chars, "")

    def byte(i: int) -> Column:
        return F.conv(F.substring(hexes, 2 * i + 1, 2), 16, 10).cast("int")

    email = F.concat(like(F.substring_index(norm, "@", 1)), F.lit("@x"), F.substring(letters, 97, 10), F.lit(".example"))
    top = 240 + byte(0) % 16 if attempt < 8 else byte(0)
    ip = F.concat_ws(".", *[c.cast("string") for c in (top, byte(1), byte(2), byte(3))])
    ip6 = F.concat_ws(":", F.lit("2001:db8"), *[F.substring(hexes, 4 * i + 1, 4) for i in range(6)])
    body = F.concat(F.substring(norm, 1, 1), F.substring(digits, F.lit(1), F.length(norm) - 2))
    card = F.concat(body, ((10 - _luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10).cast("string"))
    phone = F.concat(F.substring_index(norm, "|", 1), F.lit("|"), F.substring(digits, F.lit(1), F.length(F.substring_index(norm, "|", -1))))
    ssn = F.concat(F.lit("9"), F.substring(digits, F.lit(1), F.length(norm) - 1))
    secret = F.when(norm.rlike("^[0-9a-f]+$"), F.array_join(F.transform(F.split(norm, ""), lambda c, i: at(hexes, i)), "")).otherwise(like(norm))

    def name(consonants: str, vowels: str, endings: tuple[str, ...]) -> Column:
        syllables = [F.substring(F.lit(s), byte(j) % len(s) + 1, F.lit(1)) for k in range(3 + attempt) for j, s in ((2 * k, consonants), (2 * k + 1, vowels))]
        male, female, other, family = endings
        end = F.when(kind == "family", family).when(gender == "m", male).when(gender == "f", female).otherwise(other)
        return F.initcap(F.concat(*syllables, end))

    names = None
    for pattern, *rest in SCRIPTS.values():
        names = F.when(norm.rlike(pattern), name(*rest)) if names is None else names.when(norm.rlike(pattern), name(*rest))
    return (
        F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "ip6", ip6).when(kind == "card", card).when(kind == "phone", phone)
        .when(kind == "ssn", ssn).when(kind == "secret", secret).otherwise(names)
    )


def _laid_out(kind: Column, value: Column, surrogate: Column) -> Column:
    """The surrogate in the format of the mention: its digits in the places of the mention's digits."""
    fill = _digits(surrogate)
    seen = F.transform(F.split(value, ""), lambda c, i: F.when(c.rlike("[0-9]"), F.substring(fill, F.length(_digits(F.substring(value, F.lit(1), i + 1))), F.lit(1))).otherwise(c))
    return F.when(kind.isin("card", "ssn", "phone"), F.array_join(seen, "")).otherwise(surrogate)


def surrogates(entities: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """(kind, gender, norm, surrogate) of distinct entities, with the collision checks."""
    ids = ["kind", "gender", "norm"]
    todo = saved(entities.select(*ids).distinct(), "entities")
    real = todo.select("kind", F.col("norm").alias("_s"), F.lit(True).alias("_real")).distinct()
    done = None
    for attempt in range(ROUNDS):
        drawn = todo.withColumn("surrogate", _drawn(F.col("kind"), F.col("gender"), F.col("norm"), key, attempt))
        drawn = drawn.withColumn("_s", F.when(F.col("kind") == "secret", F.col("surrogate")).otherwise(F.lower("surrogate")))
        winner = drawn.groupBy("kind", "_s").agg(F.min(F.struct("gender", "norm")).alias("_first"))
        checked = drawn.join(winner, ["kind", "_s"]).join(real, ["kind", "_s"], "left")
        free = F.col("_real").isNull() & (F.struct("gender", "norm") == F.col("_first"))
        if done is not None:
            checked = checked.join(done.select("kind", "_s", F.lit(True).alias("_taken")), ["kind", "_s"], "left")
            free = free & F.col("_taken").isNull()
        checked = saved(checked.select(*ids, "surrogate", "_s", free.alias("_free")), "draws")
        good = checked.filter("_free").select(*ids, "surrogate", "_s")
        done = good if done is None else done.unionByName(good)
        todo = checked.filter("NOT _free").select(*ids)
        if not todo.head(1):
            return done.drop("_s")
    raise ValueError(f"entities left without a free surrogate after {ROUNDS} draws")


def replaced_texts(texts: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """(key, text, n_entities) of distinct texts (key, text) that may hold entities."""
    # outer: a plain explode would have the pieces computed again for a filter
    pieces = texts.select("key", F.posexplode_outer(_pieces(F.col("text"))).alias("pos", "t")).select("key", "pos", "t.*")
    pieces = saved(pieces.withColumn("norm", F.when(F.col("kind") != "", _normal(F.col("kind"), F.col("value")))), "pieces")
    mentions = pieces.filter("kind <> ''")
    found = mentions.join(surrogates(mentions, key), ["kind", "gender", "norm"])
    new = found.select("key", "pos", _laid_out(F.col("kind"), F.col("value"), F.col("surrogate")).alias("value"), F.lit(1).alias("entity"))
    whole = new.unionByName(pieces.filter("kind = ''").select("key", "pos", "value", F.lit(0).alias("entity")))
    ordered = F.sort_array(F.collect_list(F.struct("pos", "value")))
    return whole.groupBy("key").agg(ordered.alias("p"), F.sum("entity").alias("n_entities")).select(
        "key", F.array_join(F.col("p.value"), "").alias("text"), "n_entities"
    )


def may_hold_entity(text: Column) -> Column:
    """Whether any pattern matches; each is tried only on texts with what all
    its matches have, which a plain search tells much faster."""

    def has(*parts: str) -> Column:
        return reduce(Column.__or__, [F.contains(text, F.lit(p)) for p in parts])

    found = (
        (has("@") & text.rlike(EMAIL)) | (text.rlike("[0-9]") & text.rlike(NUMBERS))
        | (has(*SECRET_SIGNS) & text.rlike(SECRET)) | (has(*ADDRESSES) & text.rlike(PERSON))
    )
    return F.coalesce(found, F.lit(False))


def with_surrogates(docs: DataFrame, count: str, key: str = DEFAULT_KEY, text: str = "text") -> DataFrame:
    """``docs`` with its text column replaced, and column ``count`` for the number of entities."""
    columns = docs.columns
    hit = may_hold_entity(F.col(text))
    mark = fresh_name(docs, "_key")
    held = docs.filter(hit).withColumn(mark, text_key(F.col(text)))
    texts = held.select(F.col(mark).alias("key"), F.col(text).alias("text")).groupBy("key").agg(F.first("text").alias("text"))
    new = replaced_texts(texts, key).select(F.col("key").alias(mark), F.col("text").alias(f"{mark}text"), F.col("n_entities").alias(f"{mark}n"))
    done = held.join(new, mark)
    changed = [F.col(f"{mark}text").alias(text) if c == text else F.col(c) for c in columns]
    changed = done.select(*changed, F.col(f"{mark}n").cast("long").alias(count))
    return docs.filter(~hit).withColumn(count, F.lit(0).cast("long")).select(*columns, count).unionByName(changed)


def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with surrogates for personal data."""
    return with_surrogates(table(spark, sf_dir, "documents").select("doc_id", "text"), "n_entities")
