"""Personal data replaced by keyed surrogates.

Entities are detected by patterns, reduced to a core that does not depend on how they are
written, and each core gets one surrogate, derived from a secret key: the same core gets the
same surrogate everywhere, different cores of a kind get different ones. A surrogate that
another core has, or that is itself an entity of the corpus, is drawn again. Each occurrence
is rendered in its own format. DataFrame expressions and joins only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import column_named, stored

_WORD = r"[\p{Lu}][\p{L}'’-]*\p{L}"
_MALE = r"Mr|Herrn?|Monsieur|Señor|Sr|Don|Господин|господин"
_FEMALE = r"Mrs|Ms|Miss|Frau|Madame|Mme|Mlle|Señora|Sra|Doña|Госпожа|госпожа"
_OPEN = r"Dr|Prof"
#: Kinds with their patterns; where two begin at one place the first one counts.
KINDS = {
    "email": r"[\p{L}\p{N}._%+\-]+@(?:[\p{L}\p{N}\-]+\.)+\p{L}{2,}",
    "key": r"\bAKIA[0-9A-Z]{16}\b",
    "secret": r"""(?i:\b(?:password|passwd|secret|token|api_?key)\s?[=:]\s?)["']?[A-Za-z0-9+/_\-]{8,}["']?""",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]?\d)",
    "phone": r"(?<![\w+])\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,4}(?!\d)",
    "card": r"(?<![\d\-])(?:\d{4}[ \-]){3}\d{4}(?![\d\-])|(?<!\d)\d{13,19}(?!\d)",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "local": r"(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)",
    "name": rf"\b(?:{_MALE}|{_FEMALE}|{_OPEN})\.? {_WORD}(?: {_WORD}){{0,2}}",
}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())

#: Syllables of surrogate names by script and use.
_NAMES = {
    ("latin", "m"): ("Al Be Da Jo Ma Ro Ti Vi", "ber dri fre mar nal ric tho vin", "to rt as us on el or ik"),
    ("latin", "f"): ("An Cla El Ju Li Ma So Vi", "be li mi na ra ri so vi", "na ra la ta da lia nia sa"),
    ("latin", "family"): ("Bar Col Dor Fen Gar Hol Kel Mar", "be do le ni ra si to vi", "man ner ton well rick son dal mer"),
    ("cyrillic", "m"): ("Ал Бо Вик Да Ма Ни Па Се", "ва де ли ма ни ро се то", "н р с л м в й д"),
    ("cyrillic", "f"): ("Ал Ве Ди Ел Ли Ма На Та", "ва ди ли ма ни ри се та", "на ра ла са да ма ня ша"),
    ("cyrillic", "family"): ("Бар Вол Гор Дор Кар Мор Пет Сол", "ба ве до ли на ро се ту", "нов рин ков син лев дин мов вин"),
}
_ROUNDS = 40


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def _kind(value: Column) -> Column:
    """The kind of a matched text."""
    out = F.lit(None).cast("string")
    for name, pattern in reversed(KINDS.items()):
        # Look-arounds were met in the text; here the match stands alone.
        out = F.when(value.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(out)
    return out


def _part(kind: Column, core: Column, shown: Column, before: Column) -> Column:
    return F.struct(kind.alias("kind"), core.alias("core"), shown.alias("shown"), before.alias("before"))


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"^\p{IsCyrillic}"), "cyrillic").otherwise("latin")


def _parts(value: Column, kind: Column) -> Column:
    """What of a match is replaced: (kind, core, shown, text before it)."""
    none = F.lit("")
    whole = lambda core: F.array(_part(kind, core, value, none))
    title, names = F.substring_index(value, " ", 1), F.slice(F.split(value, " "), 2, 9)
    bare = F.regexp_replace(title, r"\.$", "")
    gender = F.when(bare.rlike(f"^(?:{_MALE})$"), "m").when(bare.rlike(f"^(?:{_FEMALE})$"), "f").otherwise("m")
    n = F.size(names)
    named = F.transform(
        names,
        lambda w, i: _part(
            F.concat(F.lit("name-"), _script(w), F.lit("-"), F.when(i == n - 1, "family").otherwise(gender)),
            F.lower(w),
            w,
            F.when(i == 0, F.concat(title, F.lit(" "))).otherwise(F.lit(" ")),
        ),
    )
    lead = F.regexp_extract(value, r"""^(.*?[=:]\s?["']?)""", 1)
    secret = F.regexp_replace(F.substring(value, F.length(lead) + 1, F.length(value)), r"""["']$""", "")
    quote = F.regexp_extract(value, r"""(["'])$""", 1)
    return (
        F.when(kind == "name", named)
        .when(kind == "secret", F.array(_part(kind, secret, secret, lead), _part(F.lit("plain"), quote, quote, none)))
        .when(kind.isin("phone", "card", "ssn", "local"), whole(_digits(value)))
        .when(kind == "iban", whole(F.regexp_replace(value, " ", "")))
        .when(kind == "email", whole(F.lower(value)))
        .otherwise(whole(value))
    )


def _number(digest: Column, i: Column) -> Column:
    """The i-th of 32 numbers from 0 to 65,535 that a digest gives; later ones repeat."""
    return F.conv(F.substring(digest, F.pmod(i, F.lit(32)) * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _alike(value: Column, digest: Column, first: int = 0) -> Column:
    """Each digit, letter of a script and case replaced by another of its sort; the first
    ``first`` characters and all others stay."""

    def pick(alphabet: str, i: Column) -> Column:
        return F.substring(F.lit(alphabet), F.pmod(_number(digest, i), F.lit(len(alphabet))) + 1, F.lit(1))

    hexadecimal = value.rlike("^(?=.*[0-9])(?:[0-9a-f]+|[0-9A-F]+)$")

    def one(c: Column, i: Column) -> Column:
        return (
            F.when(i < first, c)
            .when(c.rlike("[0-9]"), pick("0123456789", i))
            .when(c.rlike("[a-z]"), F.when(hexadecimal, pick("abcdef", i)).otherwise(pick("abcdefghijklmnopqrstuvwxyz", i)))
            .when(c.rlike("[A-Z]"), F.when(hexadecimal, pick("ABCDEF", i)).otherwise(pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", i)))
            .when(c.rlike(r"[\p{IsCyrillic}&&\p{Ll}]"), pick("абвгдежзиклмнопрстуфхцчшэюя", i))
            .when(c.rlike(r"[\p{IsCyrillic}&&\p{Lu}]"), pick("АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ", i))
            .when(c.rlike(r"[\p{IsGreek}&&\p{Ll}]"), pick("αβγδεζηθικλμνξοπρστυφχψω", i))
            .when(c.rlike(r"[\p{IsGreek}&&\p{Lu}]"), pick("ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ", i))
            .when(c.rlike(r"\p{Lu}"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", i))
            .when(c.rlike(r"\p{Ll}"), pick("abcdefghijklmnopqrstuvwxyz", i))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _luhn(digits: Column) -> Column:
    """Sum of a number by the rule of card numbers; a multiple of ten if it is valid."""
    each = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(i % 2 == 1, F.pmod(c.cast("int") * 2, F.lit(9)) + F.when(c == "9", 9).otherwise(0)).otherwise(c.cast("int")),
    )
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def _surrogate(kind: Column, core: Column, digest: Column, attempt: Column) -> Column:
    """The surrogate core of an attempt. Later attempts have more room than the format."""
    zero = F.lit(0)
    more = F.when(attempt > 3, F.substring(digest, 100, F.least(attempt, F.lit(20)))).otherwise("")
    octets = [F.pmod(_number(digest, F.lit(i)), F.lit(m)) + a for i, (m, a) in enumerate(((223, 1), (256, 0), (256, 0), (254, 1)))]
    local = F.substring_index(core, "@", 1)
    labels = F.split(F.substring_index(core, "@", -1), r"\.")
    inner = F.transform(F.slice(labels, 1, F.greatest(F.size(labels) - 2, zero)), lambda x: F.concat(_alike(x, F.reverse(digest)), F.lit(".")))
    ending = F.element_at(F.array(*map(F.lit, ("com", "net", "org"))), F.pmod(_number(digest, F.lit(31)), F.lit(3)) + 1)
    email = F.concat(_alike(local, digest), more, F.lit("@"), F.array_join(inner, ""), F.lit("example."), ending)
    card = _alike(core, digest, 1)
    open_card = F.concat(F.substring(card, F.lit(1), F.length(card) - 1), F.lit("0"))
    check = F.pmod(10 - F.pmod(_luhn(open_card), F.lit(10)), F.lit(10))
    off = F.when(F.pmod(_luhn(core), F.lit(10)) == 0, 0).otherwise(1 + F.pmod(_number(digest, F.lit(30)), F.lit(9)))
    card = F.concat(F.substring(card, F.lit(1), F.length(card) - 1), F.pmod(check + off, F.lit(10)).cast("string"))
    out = F.concat(_alike(core, digest), more)
    for (script, use), syllables in _NAMES.items():
        first, middle, last = (F.array(*map(F.lit, s.split())) for s in syllables)
        at = lambda part, i: F.element_at(part, F.pmod(_number(digest, i), F.lit(8)) + 1)  # noqa: E731, B023
        # Every attempt has one more syllable in the middle.
        longer = F.transform(F.sequence(F.lit(0), F.least(attempt, F.lit(12))), lambda k: at(middle, k + 8))  # noqa: B023
        name = F.concat(at(first, F.lit(0)), F.array_join(longer, ""), at(last, F.lit(2)))
        out = F.when(kind == f"name-{script}-{use}", F.lower(name)).otherwise(out)
    return (
        F.when(kind == "ip", F.concat_ws(".", *[o.cast("string") for o in octets]))
        .when(kind == "email", email)
        .when(kind == "card", card)
        .when(kind == "key", _alike(core, digest, 4))
        .when(kind == "iban", _alike(core, digest, 2))
        .when(kind.isin("phone", "ssn", "local"), _alike(core, digest, 1))
        .otherwise(out)
    )


def assign_surrogates(cores: DataFrame, key: str) -> DataFrame:
    """``cores`` (kind, core), without repeats, with their ``surrogate``; see the module.

    In every round the cores without one draw from the key, their own text and the number of
    the round. Of equal draws the smallest core wins; a draw that is a core of the kind, or was
    won before, is lost by all.
    """
    cores = stored(cores, "pii-cores")
    taken, open_cores = None, cores
    for attempt in range(_ROUNDS):
        digest = F.sha2(F.concat_ws("\u0001", F.lit(key), "kind", "core", F.lit(str(attempt))), 512)
        draw = _surrogate(F.col("kind"), F.col("core"), F.col("digest"), F.lit(attempt)).alias("surrogate")
        drawn = stored(open_cores.withColumn("digest", digest).select("kind", "core", draw), "pii-drawn")
        won = drawn.groupBy("kind", "surrogate").agg(F.min("core").alias("core"))
        won = won.join(cores.select("kind", F.col("core").alias("surrogate")), ["kind", "surrogate"], "left_anti")
        if taken is not None:
            won = won.join(taken.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        won = won.select("kind", "core", "surrogate")
        taken = stored(won if taken is None else taken.union(won), "pii-map")
        open_cores = stored(cores.join(taken, ["kind", "core"], "left_anti"), "pii-open")
        if open_cores.isEmpty():
            return taken
    raise RuntimeError(f"no surrogates without collision in {_ROUNDS} rounds")


def _rendered(shown: Column, kind: Column, surrogate: Column) -> Column:
    """The surrogate in the format of an occurrence: its marks between digits, or its case."""
    at = lambda i: F.length(F.regexp_replace(F.substring(shown, F.lit(1), i + 1), r"\D", ""))
    numbers = F.array_join(
        F.transform(F.split(shown, ""), lambda c, i: F.when(c.rlike("[0-9]"), F.substring(surrogate, at(i), F.lit(1))).otherwise(c)), ""
    )
    close = lambda i: F.length(F.regexp_replace(F.substring(shown, F.lit(1), i + 1), " ", ""))
    spaced = F.array_join(F.transform(F.split(shown, ""), lambda c, i: F.when(c != " ", F.substring(surrogate, close(i), F.lit(1))).otherwise(c)), "")
    upper = (F.upper(shown) == shown) & (F.lower(shown) != shown)
    return (
        F.when(kind.isin("phone", "card", "ssn", "local"), numbers)
        .when(kind == "iban", spaced)
        .when(kind == "email", F.when(upper, F.upper(surrogate)).otherwise(surrogate))
        .when(kind.startswith("name-"), F.when(upper & (F.length(shown) > 1), F.upper(surrogate)).otherwise(F.initcap(surrogate)))
        .otherwise(surrogate)
    )


def replace_personal_data(docs: DataFrame, key: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Returns the id column, the text with surrogates and ``n_entities`` (long) of every row.

    Found are e-mail addresses, phone, card, account and social security numbers, IPv4
    addresses, access keys and named secrets, and names after a title. Numbers keep their
    length and marks, cards also whether they are valid, names their gender (by the title),
    script and case, e-mail addresses get a reserved domain. A null text stays null, texts
    without entities are returned as they are. Repeated rows and null ids are kept; equal
    entities get equal surrogates in all rows. Empty tables stay empty, other columns are
    ignored.
    """
    source = docs.select(column_named(docs, id_column).alias("id"), column_named(docs, text).cast("string").alias("text"))
    source = source.withColumn("h", F.xxhash64("text"))
    found = source.where(F.coalesce(F.col("text").rlike(PATTERN), F.lit(False)))
    # Repeated rows have the same entities, which are listed once.
    matches = found.select("id", "h", F.posexplode_outer(F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))).alias("pos", "value"))
    kinds = matches.distinct().withColumn("kind", _kind(F.col("value"))).where("value is not null")
    exploded = kinds.select("id", "h", "pos", F.posexplode_outer(_parts(F.col("value"), F.col("kind"))).alias("part", "p"))
    parts = stored(exploded.select("id", "h", "pos", "part", "p.*"), "pii-parts")
    cores = parts.where("kind <> 'plain'").select("kind", "core").distinct()
    chosen = assign_surrogates(cores, key)
    shown = parts.join(chosen, ["kind", "core"], "left").select(
        "id", "h", "pos", "part",
        F.concat("before", F.when(F.col("surrogate").isNull(), F.col("shown")).otherwise(_rendered(F.col("shown"), F.col("kind"), F.col("surrogate")))).alias("piece"),
    )
    joined = shown.groupBy("id", "h", "pos").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "piece"))), lambda p: p["piece"]), "").alias("piece"))
    lists = joined.groupBy("id", "h").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "piece"))), lambda p: p["piece"]).alias("pieces"))
    lists = lists.select(F.col("id").alias("id2"), F.col("h").alias("h2"), "pieces")
    # The pattern is not searched again: rows without a list have no entity.
    together = source.join(lists, source["id"].eqNullSafe(lists["id2"]) & (source["h"] == lists["h2"]), "left")
    between = F.split("text", PATTERN, -1)
    woven = F.array_join(F.transform(F.arrays_zip(between.alias("gap"), F.col("pieces")), lambda z: F.concat(z["gap"], F.coalesce(z["pieces"], F.lit("")))), "")
    return together.select(
        F.col("id").alias(id_column),
        F.when(F.col("pieces").isNull(), F.col("text")).otherwise(woven).alias(text),
        F.coalesce(F.size("pieces"), F.lit(0)).cast("long").alias("n_entities"),
    )
