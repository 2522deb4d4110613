"""Personal data replaced by keyed surrogates of the same type, format, script and gender.

Entities: e-mail addresses, phone, card and social security numbers, IPv4 addresses,
access keys and assigned secrets, and names after a title. Each distinct entity gets
one surrogate, derived from a key, so every mention of it reads alike whatever its
spelling (case of an address, separators of a number, title of a name). Surrogates
are checked: where two entities of a kind meet in one, or one equals a real entity,
all but the first are derived anew until all differ. A form with too few values for
that (three digits after a country code) has its entities exchanged among each other.

Only entities are shuffled, and only rows that hold one are joined; texts without
any pass by. Built-in functions only.

Defined results: a null text stays null, an empty one empty. Rows alike change alike.
A value that is no entity keeps every character. Other columns pass by untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimflow.llm.quality_rules import computed_once
from dimflow.session import stage_table

# Titles by gender.
MALE = ["Mr.", "Herr", "Monsieur", "Señor", "Sr.", "господин"]
FEMALE = ["Mrs.", "Ms.", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra.", "госпожа"]
NEUTRAL = ["Dr.", "Prof."]

FIRST_NAMES = {
    "m": ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karim", "Leo"],
    "f": ["Alma", "Berta", "Clara", "Dora", "Emma", "Flora", "Greta", "Helena", "Irene", "Julia", "Karin", "Lena"],
    "n": ["Alex", "Charlie", "Eden", "Jamie", "Kim", "Luca", "Noa", "Robin", "Sam", "Sasha", "Toni", "Yuri"],
}
SYLLABLES = "ba be bo da de do fa fe ga go ka ke la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se ta te ti to va ve vi vo".split()
CYRILLIC = "ба бе бо да де до га го ка ке ла ле ли ло ма ме ми мо на не ни но па пе ра ре ри ро са се та те ти то ва ве ви во".split()

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_TITLES = "|".join(x.replace(".", r"\.") for x in MALE + FEMALE + NEUTRAL)
_PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]{1,64}@[A-Za-z0-9\-]{1,63}(?:\.[A-Za-z0-9\-]{1,63}){0,8}\.[A-Za-z]{2,24}",
    "access": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "secret": r"(?<=(?:[Pp]assword|[Pp]asswd|[Pp]wd|[Ss]ecret|[Tt]oken|[Aa]pi[_-]?[Kk]ey)\s{0,3}[=:]\s{0,3}[\"']?)(?=[^\s\"']{0,200}\d)[^\s\"']{6,200}",
    "ip": rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)",
    "phone": r"(?<![\w+])\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .\-]?\d{2,4}){1,4}(?!\w)|(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?!\w)|(?<![\w\-])\d{3}-\d{3}-\d{4}(?![\w\-])",
    "ssn": r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])",
    "card": r"(?<![\w\-])(?:\d{13,19}|\d{4}(?:[ \-]\d{4}){3})(?![\w\-])",
    "name": rf"(?<![\p{{L}}])(?:{_TITLES}) \p{{Lu}}\p{{Ll}}{{1,40}}(?: \p{{Lu}}\p{{Ll}}{{1,40}})?",
}
_ANY = "|".join(_PATTERNS.values())
#: A text without any of these holds no entity.
_GATE = rf"[0-9@]|(?<![\p{{L}}])(?:{_TITLES}) \p{{Lu}}"


def _kind(m: Column) -> Column:
    """Type of a match."""
    return (
        F.when(m.rlike(rf"^(?:{_TITLES}) "), "name")
        .when(m.rlike("^[^@]{1,64}@[^@]+$") & ~m.contains("="), "email")
        .when(m.rlike("^AKIA[0-9A-Z]{16}$"), "access")
        .when(m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"), "ip")
        .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(m.rlike(r"^(?:\d{13,19}|\d{4}(?:[ \-]\d{4}){3})$"), "card")
        .when(m.rlike(r"^[+(]|^\d{3}-\d{3}-\d{4}$") & m.rlike(r"^[+()\d .\-]+$"), "phone")
        .otherwise("secret")
    )


def _tokens(m: Column) -> Column:
    """Entities of a match as structs of kind, normal form and gender; a name has one for each word."""
    kind = _kind(m)
    words = F.split(F.regexp_replace(m, rf"^(?:{_TITLES}) ", ""), " ")
    gender = (
        F.when(F.substring_index(m, " ", 1).isin(MALE), "m")
        .when(F.substring_index(m, " ", 1).isin(FEMALE), "f")
        .otherwise("n")
    )

    def entity(kind: Column, normal: Column, gender: Column) -> Column:
        return F.struct(kind.alias("kind"), normal.alias("normal"), gender.alias("gender"))

    named = F.transform(
        words,
        lambda w, i: entity(F.when(i < F.size(words) - 1, F.lit("first")).otherwise(F.lit("last")), w, gender),
    )
    normal = (
        F.when(kind == "email", F.lower(m))
        .when(kind.isin("phone", "card", "ssn"), F.regexp_replace(m, r"[^0-9]", ""))
        .otherwise(m)
    )
    # A phone number's country code is part of it and stays as it is.
    code = F.when(kind == "phone", F.regexp_extract(m, r"^\+(\d{1,3})(?=[ .\-(])", 1)).otherwise(F.lit("n"))
    return F.when(kind == "name", named).otherwise(F.array(entity(kind, normal, code)))


def _digest(key: str, salt: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), F.col("kind"), F.col("normal"), F.col("attempt").cast("string"), salt), 256)


def _number(key: str, salt: Column, below: int) -> Column:
    """A keyed number from 0 to below - 1."""
    return F.pmod(F.conv(F.substring(_digest(key, salt), 1, 12), 16, 10).cast("bigint"), F.lit(below)).cast("int")


def _alike(key: str, text: Column) -> Column:
    """Each letter and digit replaced by another of its class; the rest stays."""
    classes = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]

    def other(c: Column, i: Column) -> Column:
        out = c
        for own in classes:
            pick = F.substring(F.lit(own), _number(key, i.cast("string"), len(own)) + 1, F.lit(1))
            out = F.when(F.lit(own).contains(c), pick).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(text, ""), other), "")


def _luhn(digits: Column) -> Column:
    """`digits` with its last one set so that the card check holds."""
    n = F.length(digits)

    def worth(d: Column, i: Column) -> Column:
        twice = F.pmod(n - i, F.lit(2)) == 0
        v = d.cast("int")
        return F.when(twice, F.when(v > 4, 2 * v - 9).otherwise(2 * v)).otherwise(v)

    head = F.split(F.substring(digits, F.lit(1), n - 1), "")
    total = F.aggregate(F.transform(head, worth), F.lit(0), lambda a, b: a + b)
    return F.concat(F.substring(digits, F.lit(1), n - 1), F.pmod(10 - total % 10, F.lit(10)).cast("string"))


def _surrogate(key: str) -> Column:
    """Replacement of the entity in `kind`, `normal`, `gender`, at its `attempt`."""
    normal, kind = F.col("normal"), F.col("kind")
    ip = F.concat_ws(".", *[(_number(key, F.lit(str(i)), 254) + 1).cast("string") for i in range(4)])
    number = _alike(key, normal)
    code = F.length("gender")
    phone = F.concat(F.col("gender"), F.substring(number, code + 1, F.length(normal)))
    phone = F.when(F.col("gender") == "", number).otherwise(phone)
    card = _luhn(F.concat(F.substring(normal, 1, 1), F.substring(number, F.lit(2), F.length(normal))))
    local = _alike(key, F.substring_index(normal, "@", 1))
    domain = F.concat(F.lit("h"), F.substring(_digest(key, F.lit("domain")), 1, 8), F.lit(".example"))
    cyrillic = normal.rlike(r"^\p{IsCyrillic}")

    def built(syllables: list[str]) -> Column:
        table = F.array(*map(F.lit, syllables))
        count = F.sequence(F.lit(1), 3 + F.col("attempt"))
        picks = F.transform(count, lambda i: F.get(table, _number(key, i.cast("string"), len(syllables))))
        return F.initcap(F.array_join(picks, ""))

    word = F.when(cyrillic, built(CYRILLIC)).otherwise(built(SYLLABLES))
    given = F.lit(None).cast("string")
    for g, names in FIRST_NAMES.items():
        pick = F.get(F.array(*map(F.lit, names)), _number(key, F.lit("given"), len(names)))
        given = F.when(F.col("gender") == g, pick).otherwise(given)
    ending = F.when(cyrillic, F.when(F.col("gender") == "f", "на").otherwise("н"))
    ending = ending.otherwise(F.when(F.col("gender") == "f", "na").otherwise("n"))
    first = F.when((F.col("attempt") == 0) & ~cyrillic, given).otherwise(F.concat(word, ending))
    return (
        F.when(kind == "email", F.concat(local, F.lit("@"), domain))
        .when(kind == "ip", ip)
        .when(kind == "phone", phone)
        .when(kind == "card", card)
        .when(kind == "ssn", number)
        .when(kind == "access", F.concat(F.lit("AKIA"), F.substring(number, F.lit(5), F.lit(16))))
        .when(kind == "last", word)
        .when(kind == "first", first)
        .when(normal.rlike("^[0-9a-f]{6,64}$"), F.substring(_digest(key, F.lit("hex")), F.lit(1), F.length(normal)))
        .otherwise(number)
    )


#: Attempts after which the entities of a form that still lacks surrogates are exchanged.
ATTEMPTS = 20


def _form() -> Column:
    """What a surrogate has in common with its entity: the class of each character, or being hexadecimal."""
    own, classes = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "0" * 10 + "a" * 26 + "A" * 26
    is_hex = (F.col("kind") == "secret") & F.col("normal").rlike("^[0-9a-f]{6,64}$")
    return F.when(is_hex, F.concat(F.lit("hex "), F.length("normal").cast("string"))).otherwise(
        F.translate("normal", own, classes)
    )


def _exchanged(entities: DataFrame, key: str) -> DataFrame:
    """Each entity with the next one of its form, in keyed order, as its surrogate.

    Forms have two entities at least, so none keeps its own. Country codes are kept,
    but for a code that a single entity of its form has.
    """
    sizes = entities.groupBy("kind", "form", "gender").agg(F.count("*").alias("n"))
    most = sizes.groupBy("kind", "form").agg(F.max_by("gender", F.struct("n", "gender")).alias("most"))
    ring = F.when(F.col("n") > 1, F.col("gender")).otherwise(F.col("most"))
    rings = sizes.join(most, ["kind", "form"]).select("kind", "form", "gender", ring.alias("ring"))
    group = Window.partitionBy("kind", "form", "ring").orderBy(_digest(key, F.lit("ring")), "normal")
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.coalesce(F.lead("normal").over(group), F.first("normal").over(whole))
    return entities.join(rings, ["kind", "form", "gender"]).select("kind", "normal", following.alias("surrogate"))


def assign(entities: DataFrame, key: str) -> DataFrame:
    """`kind`, `normal`, `surrogate` of distinct entities; no two of a kind get one surrogate, and none its own value.

    An entity that has its surrogate keeps it: those derived anew come after it. No
    surrogate is a real entity, except in forms that hold too few values: where some
    of a form still lack one after ATTEMPTS, all entities of that form are exchanged.
    """
    own = entities.groupBy("kind", "normal").agg(F.min("gender").alias("gender"))
    now = stage_table(own.withColumn("attempt", F.lit(0)).withColumn("surrogate", _surrogate(key)), "entities")
    real = now.select("kind", F.col("normal").alias("surrogate"), F.lit(True).alias("real"))
    order = Window.partitionBy("kind", "surrogate").orderBy("attempt", "normal")
    attempts, exchanged = 0, None
    while True:
        ranked = now.join(real, ["kind", "surrogate"], "left").withColumn(
            "again", (F.row_number().over(order) > 1) | F.col("real").isNotNull()
        )
        ranked = stage_table(ranked.drop("real"), "entities")
        # A one-word name of a list can be a real one too; only more syllables part them.
        if ranked.filter("again").isEmpty():
            done = ranked.select("kind", "normal", "surrogate")
            return done.unionByName(exchanged) if exchanged is not None else done
        attempts += 1
        if attempts == ATTEMPTS:
            formed = ranked.filter("kind not in ('first', 'last')").withColumn("form", _form())
            forms = formed.groupBy("kind", "form").agg(F.count("*").alias("n"), F.bool_or("again").alias("short"))
            short = stage_table(forms.filter("short and n > 1").select("kind", "form"), "forms")
            exchanged = stage_table(_exchanged(formed.join(short, ["kind", "form"], "left_semi"), key), "exchanged")
            ranked = ranked.join(exchanged.select("kind", "normal"), ["kind", "normal"], "left_anti")
            ranked = stage_table(ranked, "entities")
        moved = ranked.filter("again").withColumn("attempt", F.col("attempt") + 1).withColumn("surrogate", _surrogate(key))
        now = ranked.filter("not again").unionByName(moved).drop("again")


def _formed(m: Column, surrogates: Column) -> Column:
    """A match rewritten with its surrogates, in its own format; both must be columns."""
    kind = _kind(m)
    first = F.get(surrogates, F.lit(0))
    name = F.concat(F.substring_index(m, " ", 1), F.lit(" "), F.array_join(surrogates, " "))
    chars = F.split(m, "")
    digits = F.aggregate(
        chars,
        F.struct(F.lit("").alias("text"), F.lit(0).alias("at")),
        lambda acc, c: F.when(
            c.rlike("[0-9]"),
            F.struct(
                F.concat(acc["text"], F.substring(first, acc["at"] + 1, F.lit(1))).alias("text"),
                (acc["at"] + 1).alias("at"),
            ),
        ).otherwise(F.struct(F.concat(acc["text"], c).alias("text"), acc["at"].alias("at"))),
        lambda acc: acc["text"],
    )
    return F.when(kind == "name", name).when(kind.isin("phone", "card", "ssn"), digits).otherwise(first)


def replace_entities(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """`docs` as the struct `row`, with `text` after replacement and `n_entities`."""
    t = F.col(f"row.{text}")
    found = docs.select(F.struct("*").alias("row"))
    matches = F.when(t.rlike(_GATE), F.regexp_extract_all(t, F.lit(_ANY), F.lit(0)))
    found = found.withColumn("matches", matches)
    # A column of its own, else the filters below would search each text twice.
    found = found.withColumn("none", computed_once(F.coalesce(F.size("matches") <= 0, F.lit(True))))
    none = F.col("none")
    plain = found.filter(none).select("row", t.alias("text"), F.lit(0).cast("bigint").alias("n_entities"))
    hits = found.filter(~none).drop("none").withColumn("id", F.monotonically_increasing_id())
    hits = stage_table(hits, "entities")  # the ids hold from here on
    each = hits.select("id", F.posexplode("matches").alias("at", "match"))
    each = each.withColumn("tokens", _tokens(F.col("match")))
    each = each.select("id", "at", "match", F.posexplode("tokens").alias("word", "token")).select("*", "token.*")
    mapping = stage_table(assign(each.select("kind", "normal", "gender"), key), "surrogates")
    put = each.join(mapping, ["kind", "normal"])
    put = put.groupBy("id", "at").agg(
        F.first("match").alias("match"), F.sort_array(F.collect_list(F.struct("word", "surrogate"))).alias("s")
    )
    put = put.withColumn("s", F.transform("s", lambda x: x["surrogate"]))
    put = put.select("id", "at", _formed(F.col("match"), F.col("s")).alias("new"))
    put = put.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("at", "new"))).alias("new"))
    parts = F.split(t, _ANY, -1)
    joined = F.zip_with(parts, F.transform("new", lambda x: x["new"]), lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    done = hits.join(put, "id").select(
        "row", F.array_join(joined, "").alias("text"), F.size("matches").cast("bigint").alias("n_entities")
    )
    return plain.union(done)
