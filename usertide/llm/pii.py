"""PII: detection and keyed surrogates, with DataFrame functions only.

One pattern finds the entities of a text, in order; the text between them stays.  Each distinct entity of the
corpus gets one surrogate, drawn from a keyed hash and of the same kind: phone numbers keep their country
code, cards a valid check digit, names their gender and script, secrets their alphabet.  Occurrences keep
their own format (spaces, brackets, case), so ``+1 (980) 555-0100`` and ``1-980-555-0100`` stay one number.
Surrogates that meet another surrogate or any original value are drawn again until all are distinct.

Names are found behind a form of address.  The parts of such a name are then replaced wherever else the same
text has them (``Smith said``), as are initials before its surname (``J. Smith``).  Numbers that look like
cards but fail the check digit aren't cards and stay, as does plain prose behind a label and a colon.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usertide.session import materialize

#: Forms of address by gender, Latin and Cyrillic.
MALE = ("Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Don", "Sir", "Signor", "господин", "Господин", "г-н")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mademoiselle", "Lady", "Señora", "Señorita", "Sra", "Doña", "Signora", "госпожа", "Госпожа", "г-жа")
NEUTRAL = ("Dr", "Prof")
#: Words within a name that start small; they stay.
PARTICLES = (
    "von", "van", "vom", "zu", "zum", "zur", "der", "den", "de", "het", "ten", "ter", "del", "della", "dello", "dei", "degli", "di", "da", "das", "do",
    "dos", "du", "des", "la", "le", "las", "los", "y", "e", "i", "und", "af", "av", "al", "el", "bin", "bint", "ibn", "ben", "фон", "де", "ван", "дер", "оглы",
)
SYLLABLES = {
    "latin": ["ba", "bel", "bo", "cor", "da", "del", "do", "fa", "fin", "ga", "hel", "jo", "ka", "lan", "mar", "mi", "na", "nor", "pe", "ra", "ros", "sa", "tor", "vi"],
    "cyrillic": ["ба", "бел", "бо", "вор", "да", "дел", "до", "фа", "фин", "га", "гел", "жо", "ка", "лан", "мар", "ми", "на", "нор", "пе", "ра", "рос", "са", "тор", "ви"],
}
ENDINGS = {
    ("latin", "m"): "n", ("latin", "f"): "lia", ("latin", "x"): "ri", ("latin", "s"): "sen", ("latin", "i"): "",
    ("cyrillic", "m"): "н", ("cyrillic", "f"): "лия", ("cyrillic", "x"): "ри", ("cyrillic", "s"): "ко", ("cyrillic", "i"): "",
}

TITLE = "(?:" + "|".join(sorted((*MALE, *FEMALE, *NEUTRAL), key=len, reverse=True)) + r")\.? "
#: One part of a name, with inner capitals, apostrophes and hyphens, or an initial; possessive, so that long names need no stack.
INITIAL = r"\p{Lu}\.(?!\p{L})"
NAME = r"(?:" + INITIAL + r"|(?:[dlDL]['’]|(?:al|el|ibn|ben)-)?\p{Lu}[\p{L}\p{M}]*+(?:['’-][\p{L}][\p{L}\p{M}]*+)*+(?![\p{L}\p{N}]))"
SMALL = "(?:(?:" + "|".join(sorted(PARTICLES, key=len, reverse=True)) + ") )"
NAMES = f"{SMALL}{{0,3}}{NAME}(?: (?!{TITLE}){SMALL}{{0,3}}{NAME})*+"
TITLES = f"(?:{TITLE}){{1,4}}"
#: Secrets with fewer letters and digits have no surrogates of their own length to spare.
SHORT = 8
#: A label with its closing quote, the sign between, and the value's opening quote.
LABEL = r"(?i:password|passwd|pwd|secret|token|api[_-]?key)[\"']?[ ]{0,2}(?::=|=>|={1,3}|:)[ ]{0,2}[\"']?"
UNQUOTED = LABEL.removesuffix(r"[\"']?")
#: A value goes up to its closing quote, whatever it holds, or where none is open up to white space.
#: Words behind a colon that go on as a sentence are no value.
PROSE = r"\p{L}[\p{L}'’-]*+(?:[.,;:!?)]++(?:\s|\z)|[ \t]{1,2}+\p{L}[\p{L}'’-]*+(?![\p{L}\p{N}_=:@]))"
VALUE = r"""(?:"(?:[^"\\\r\n]|\\.)++(?="|\z)|'(?:[^'\\\r\n]|\\.)++(?='|\z)|(?!(?<=: )""" + PROSE + r""")(?![\"']{2})["']?\S+)"""
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    "secret": r"(?<![A-Za-z0-9])" + UNQUOTED + VALUE,
    "access": r"(?<![A-Za-z0-9])A(?:KI|SI)A[0-9A-Z]{16}(?![A-Za-z0-9])",
    "hex": r"(?<![A-Za-z0-9])[0-9a-f]{32,128}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])",
    "card": r"(?<![0-9])(?:[2-6][0-9]{3}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5})(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{2,4}\)?){2,5}|(?:1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[ .-][0-9]{4}|0[1-9][0-9]{1,4}[ /-][0-9]{5,8})(?![0-9])",
    "name": r"(?<![\p{L}])" + TITLES + NAMES,
}
ENTITY = "|".join(PATTERNS.values())
#: In texts that hold a name: any other capitalised word, with the initials before it.
MENTION = (
    r"(?<![\p{L}\p{M}\p{N}_])(?:(?:\p{Lu}\. ?){1,3}+(?!" + ENTITY + r"))?+"
    r"\p{Lu}(?:['’]\p{Lu})?[\p{L}\p{M}]++(?:['’-](?!A[KS]IA)\p{Lu}[\p{L}\p{M}]++)*+(?![\p{N}_])"
)
#: The setting that holds the key of the surrogates.
KEY = "spark.usertide.pii.secret"
_OWN_KEYS: dict[str, str] = {}
#: Every entity but a name holds one of these; most texts hold none, and one look tells.
SIGNS = r"[0-9@=:]|A[KS]IA|[a-f]{32}"
PIECE = "array<struct<kind: string, key: string, raw: string, gender: string>>"


def piece(kind: Column | str | None, key: Column | None, raw: Column, gender: Column | None = None) -> Column:
    text = lambda x: F.lit(x).cast("string") if x is None or isinstance(x, str) else x.cast("string")
    return F.struct(text(kind).alias("kind"), text(key).alias("key"), raw.alias("raw"), text(gender).alias("gender"))


def kind_of(raw: Column) -> Column:
    """The kind of a match: the first pattern that fits the whole of it."""
    out = F.when(F.lit(False), F.lit(""))
    for kind, pattern in (PATTERNS | {"mention": MENTION}).items():
        out = out.when(raw.rlike(f"^(?:{pattern})$"), F.lit(kind))
    return out


def initial_key(name: Column, surname: Column) -> Column:
    """What an initial is looked up by: its letter and the surname behind it."""
    return F.concat(F.lower(F.substring(name, 1, 1)), F.lit(". "), F.lower(surname))


def pieces(raw: Column) -> Column:
    """A match as literal pieces (no kind) and entities; a name's parts are entities of their own."""
    kind = kind_of(raw)
    alone = lambda key: F.array(piece(kind, key, raw))
    label = F.regexp_extract(raw, f"^{LABEL}", 0)
    value = raw.substr(F.length(label) + 1, F.length(raw))
    title = F.regexp_extract(raw, f"^{TITLES}", 0)
    names = F.split(raw.substr(F.length(title) + 1, F.length(raw)), " ")
    bare = F.split(F.regexp_replace(title, r"\.? ", " "), " ")
    has = lambda titles: F.arrays_overlap(bare, F.array(*map(F.lit, titles)))
    gender = F.when(has(MALE) & ~has(FEMALE), "m").when(has(FEMALE) & ~has(MALE), "f").otherwise("x")

    def named(part: Column, i: Column) -> Column:
        script = F.when(part.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")
        initial = part.rlike(r"^\p{Lu}\.?$")
        role = F.when(initial, "i").when(i == F.size(names) - 1, "s").otherwise("g")
        own = F.regexp_replace(part, r"\.$", "")
        kind = F.when(~part.isin(*PARTICLES), F.concat(F.lit("name-"), script, F.lit("-"), role))
        return F.array(
            piece(None, None, F.when(i > 0, F.lit(" ")).otherwise(F.lit(""))),
            piece(kind, F.lower(own), own, F.when(role == "g", gender)),
            piece(None, None, F.when(part.endswith("."), F.lit(".")).otherwise(F.lit(""))),
        )

    whole = F.concat(F.array(piece(None, None, title)), F.flatten(F.transform(names, named)))
    plain = F.lower(F.regexp_replace(raw, "[^A-Za-z0-9]", ""))
    valid = check_digit(plain.substr(F.lit(1), F.length(plain) - 1)) == F.right(plain, F.lit(1))
    before = F.regexp_extract(raw, r"^(?:\p{Lu}\. ?)*", 0)
    word = raw.substr(F.length(before) + 1, F.length(raw))
    letters = F.regexp_extract_all(before, F.lit(r"\p{Lu}\. ?"), F.lit(0))
    initials = F.transform(letters, lambda x: piece("initial", initial_key(x, word), x))
    return (
        F.when(kind == "name", whole)
        .when(kind == "secret", F.array(piece(None, None, label), piece(kind, F.lower(F.regexp_replace(value, r"[^\p{L}\p{N}]", "")), value)))
        .when(kind == "mention", F.concat(initials, F.array(piece(kind, F.lower(word), word))))
        .when((kind == "card") & ~valid, F.array(piece(None, None, raw)))
        .when(kind.isin("email", "ip"), alone(F.lower(raw)))
        .otherwise(alone(plain))
        .cast(PIECE)
    )


def draws(secret: str, kind: Column, key: Column, attempt: Column) -> Column:
    """A keyed stream of hexadecimal digits, two for each character of the key and more."""
    seed = F.concat_ws("\u0001", F.lit(secret), kind, key, attempt.cast("string"))
    blocks = F.sequence(F.lit(0), F.floor(F.length(key) / 60).cast("int") + 1)
    return F.array_join(F.transform(blocks, lambda b: F.sha2(F.concat_ws("\u0001", seed, b.cast("string")), 512)), "")


def number(stream: Column, i: Column | int, size: int) -> Column:
    """The i-th draw from 0 to size - 1; 16 bits feed it, so that no value is much likelier."""
    at = (i if isinstance(i, Column) else F.lit(i)) * 2 + 1
    return F.pmod(F.conv(F.substring(stream, at, F.lit(4)), 16, 10).cast("int"), F.lit(size))


def one_of(values: str, at: Column) -> Column:
    return F.substring(F.lit(values), at + 1, F.lit(1))


def masked(kind: Column, key: Column, stream: Column) -> Column:
    """Digits for digits and letters for letters; hexadecimal strings stay so."""

    def char(c: Column, i: Column) -> Column:
        letter = F.when(key.rlike("^[0-9a-f]+$"), one_of("abcdef", number(stream, i, 6))).otherwise(one_of("abcdefghijklmnopqrstuvwxyz", number(stream, i, 26)))
        return F.when(c.rlike("[0-9]"), one_of("0123456789", number(stream, i, 10))).otherwise(letter)

    return F.array_join(F.transform(F.split(key, ""), char), "")


def shifted(key: Column, stream: Column) -> Column:
    """``masked`` with no character as it was, and digits of the stream behind it.

    There are fewer short strings than short secrets may need, so only the whole is distinct; what is shown, its
    beginning, still differs from the original.
    """

    def moved(values: str, c: Column, i: Column) -> Column:
        return one_of(values, F.pmod(F.position(c, F.lit(values)) + number(stream, i, len(values) - 1), F.lit(len(values))))

    char = lambda c, i: F.when(c.rlike("[0-9]"), moved("0123456789", c, i)).otherwise(moved("abcdefghijklmnopqrstuvwxyz", c, i))
    return F.concat(F.array_join(F.transform(F.split(key, ""), char), ""), F.substring(stream, 41, 16))


def check_digit(body: Column) -> Column:
    """The Luhn digit that follows the digits of ``body``."""
    total = F.aggregate(
        F.transform(F.reverse(F.split(body, "")), lambda d, i: F.when(i % 2 == 0, d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)).otherwise(d.cast("int"))),
        F.lit(0),
        lambda a, d: a + d,
    )
    return F.pmod(-total, F.lit(10)).cast("string")


def remainder(text: Column) -> Column:
    """The remainder by 97 of digits and small letters, a letter being a number from 10 on."""
    digit = lambda a, c: F.when(c.rlike("[0-9]"), a * 10 + c.cast("int")).otherwise(a * 100 + F.ascii(c) - 87)
    return F.aggregate(F.split(text, ""), F.lit(0), lambda a, c: F.pmod(digit(a, c), F.lit(97)).cast("int"))


def telephone(key: Column, mask: Column, stream: Column) -> Column:
    """A number with its country code, and an area code and exchange as they are given out.

    Ten digits are national, those before them the country code; of a number with a leading 0 that stays.
    Numbers of fewer digits are masked, those of eight and nine but for two of the country code.
    """
    size = F.length(key)
    local = key.startswith("0")
    cut = F.when(local, 1).when(size < 8, 0).when(size < 10, 2).otherwise(size - 10)
    drawn = lambda i, values: one_of(values, number(stream, cut + i, len(values)))
    area = F.concat(drawn(0, "23456789"), drawn(1, "2345678"), mask.substr(cut + 3, F.lit(1)))
    full = F.concat(area, drawn(3, "23456789"), drawn(4, "23456789"), mask.substr(cut + 6, size))
    rest = F.when(local, F.concat(drawn(0, "123456789"), mask.substr(cut + 2, size))).when(size < 10, mask.substr(cut + 1, size)).otherwise(full)
    return F.concat(key.substr(F.lit(1), cut), rest)


def invented(script: str, ending: str, stream: Column, attempt: Column) -> Column:
    """A name of syllables; each failed draw makes it longer by one, so there are always enough."""
    syllables = SYLLABLES[script]
    drawn = F.transform(F.sequence(F.lit(0), F.lit(2) + attempt), lambda i: F.get(F.array(*map(F.lit, syllables)), number(stream, i * 2, len(syllables))))
    return F.concat(F.array_join(drawn, ""), F.lit(ending))


def surrogate(kind: Column, key: Column, attempt: Column, stream: Column) -> Column:
    """The value of an entity's key from its stream: of its kind, and never in use where a reserved range exists."""
    mask = masked(kind, key, stream)
    size = F.length(key)
    card = F.concat(F.substring(key, 1, 1), mask.substr(F.lit(2), size - 2))
    account = mask.substr(F.lit(5), size)
    country = F.substring(key, 1, 2)
    iban = F.concat(country, F.lpad((98 - remainder(F.concat(account, country, F.lit("00")))).cast("string"), 2, "0"), account)
    local = F.substring_index(mask_keeping(kind, key, stream), "@", 1)
    domain = F.regexp_replace(F.substring_index(mask_keeping(kind, key, stream), "@", -1), r"[^.]+$", "example")
    ip = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (number(stream, i * 2, 254) + 1).cast("string")), ".")
    out = (
        F.when(kind == "email", F.concat(local, F.lit("@"), domain))
        .when(kind == "ip", ip)
        .when((kind == "secret") & (size < SHORT), shifted(key, stream))
        .when(kind == "card", F.concat(card, check_digit(card)))
        .when(kind == "phone", telephone(key, mask, stream))
        .when(kind == "ssn", F.concat(F.lit("9"), mask.substr(F.lit(2), size)))
        .when(kind == "access", F.concat(F.substring(key, 1, 4), mask.substr(F.lit(5), size)))
        .when(kind == "iban", iban)
    )
    for (script, gender), ending in ENDINGS.items():
        out = out.when(kind == f"name-{script}-{gender}", invented(script, ending, stream, attempt))
    return out.otherwise(mask)


def mask_keeping(kind: Column, key: Column, stream: Column) -> Column:
    """``masked``, with everything but letters and digits kept."""
    char = lambda c, i: F.when(c.rlike("[0-9]"), one_of("0123456789", number(stream, i, 10))).when(c.rlike("[a-z]"), one_of("abcdefghijklmnopqrstuvwxyz", number(stream, i, 26))).otherwise(c)
    return F.array_join(F.transform(F.split(key, ""), char), "")


def formatted(kind: Column, raw: Column, value: Column) -> Column:
    """A surrogate in the format of one occurrence: its separators and its case."""

    def step(acc: Column, c: Column) -> Column:
        own = F.substring(value, acc["at"] + 1, F.lit(1))
        own = F.when(c.rlike(r"\p{Lu}"), F.upper(own)).otherwise(own)
        fits = c.rlike("[A-Za-z0-9]") | ((kind == "secret") & c.rlike(r"[\p{L}\p{N}]"))
        return F.struct(F.concat(acc["text"], F.when(fits, own).otherwise(c)).alias("text"), (acc["at"] + F.when(fits, 1).otherwise(0)).alias("at"))

    filled = F.aggregate(F.split(raw, ""), F.struct(F.lit("").alias("text"), F.lit(0).alias("at")), step, lambda acc: acc["text"])
    # Initials are fewer than the names they stand for: one shows a letter of its value, never its own.
    first = F.upper(F.substring(value, 1, 1))
    initial = F.when(first == F.substring(raw, 1, 1), F.upper(F.substring(value, 2, 1))).otherwise(first)
    short = F.when(kind.endswith("-i"), initial).when(raw.rlike(r"^\p{Lu}\. ?$"), F.concat(initial, raw.substr(F.lit(2), F.length(raw))))
    name = short.when((raw == F.upper(raw)) & (F.length(raw) > 1), F.upper(value)).otherwise(F.initcap(value))
    return F.when(kind.startswith("name-"), name).when(kind.isin("email", "ip"), F.when(raw == F.upper(raw), F.upper(value)).otherwise(value)).otherwise(filled)


def surrogates(entities: DataFrame, secret: str) -> DataFrame:
    """Rows ``kind, key, value`` for distinct rows ``kind, key``, all values distinct and none an original.

    Of entities that draw the same value the first by key has it; the others, and those that draw a value
    in use or an original, draw again in the next round.
    """
    originals = entities.select(F.col("key").alias("value")).distinct()
    pending = materialize(entities.select("kind", "key").withColumn("attempt", F.lit(0)))
    done: DataFrame | None = None
    while not pending.isEmpty():
        streams = pending.withColumn("stream", draws(secret, F.col("kind"), F.col("key"), F.col("attempt")))
        drawn = materialize(streams.withColumn("value", surrogate(F.col("kind"), F.col("key"), F.col("attempt"), F.col("stream"))).drop("stream"))
        free = drawn.join(originals, "value", "left_anti")
        if done is not None:
            free = free.join(done.select("value"), "value", "left_anti")
        first = free.groupBy("value").agg(F.min(F.struct("kind", "key")).alias("one"))
        own = materialize(first.select("one.kind", "one.key", "value"))
        pending = materialize(drawn.join(own.select("kind", "key"), ["kind", "key"], "left_anti").select("kind", "key", (F.col("attempt") + 1).alias("attempt")))
        done = own if done is None else done.union(own)
    return done if done is not None else pending.select("kind", "key", F.lit(None).cast("string").alias("value"))


def resolved(parts: DataFrame) -> DataFrame:
    """Rows ``kind, key`` of the distinct entities; a given name's kind ends in the gender of all its mentions.

    Mentions without a gender follow the others; a name of both has neither, so it keeps one surrogate.
    """
    held = lambda g: F.max(F.coalesce(F.col("gender") == g, F.lit(False)))
    each = parts.where("kind is not null and key is not null").groupBy("kind", "key").agg(held("m").alias("m"), held("f").alias("f"))
    gender = F.when(F.col("m") & ~F.col("f"), "m").when(F.col("f") & ~F.col("m"), "f").otherwise("x")
    given = F.col("kind").startswith("name-") & F.col("kind").endswith("-g")
    return each.select(F.when(given, F.concat(F.regexp_replace("kind", "g$", ""), gender)).otherwise(F.col("kind")).alias("kind"), "key")


def mentions_resolved(parts: DataFrame) -> DataFrame:
    """``parts`` with mentions and initials as the names of the same text that they repeat, or as literal pieces.

    A word that the text has both as given name and as surname counts as given name; an initial of several
    names with one surname stands for the first of them by key.
    """
    names = parts.where("kind like 'name-%-g' or kind like 'name-%-s'").select("__digest", "i", "key", "kind")
    given, last = names.where("kind like '%-g'"), names.where("kind like '%-s'").select("__digest", "i", F.col("key").alias("surname"))
    short = given.join(last, ["__digest", "i"]).select("__digest", initial_key(F.col("key"), F.col("surname")).alias("short"), "kind", "key")
    whole = names.select("__digest", F.col("key").alias("short"), "kind", "key")
    known = whole.union(short).groupBy("__digest", "short").agg(F.min(F.struct("kind", "key")).alias("own"))
    open_ = parts.where("kind in ('mention', 'initial')").withColumnRenamed("key", "short").join(known, ["__digest", "short"], "left")
    found = open_.select("__digest", "i", "j", F.col("own.kind").alias("kind"), F.col("own.key").alias("key"), "raw", "gender")
    return parts.where("kind is null or kind not in ('mention', 'initial')").select(*found.columns).union(found)


def has_name(text: Column) -> Column:
    """Whether a text holds a name behind a form of address."""
    titled = F.lit(False)
    for title in (*MALE, *FEMALE, *NEUTRAL):
        titled = titled | text.contains(title)
    return F.coalesce(titled & text.rlike(PATTERNS["name"]), F.lit(False))


def has_entities(text: Column) -> Column:
    """Whether ``ENTITY`` is found in a text; the long patterns run only where a cheap sign of them stands."""
    most = "|".join(pattern for kind, pattern in PATTERNS.items() if kind != "name")
    return F.coalesce((text.rlike(SIGNS) & text.rlike(most)) | has_name(text), F.lit(False))


def key_of(spark: SparkSession) -> str:
    """The key that the session names in ``spark.usertide.pii.secret``, else one drawn for this application.

    Whoever knows the key can draw the surrogates again, so there is no fixed one.  A drawn key makes
    surrogates agree within an application only; set the key where several runs must agree.
    """
    return spark.conf.get(KEY, None) or _OWN_KEYS.setdefault(spark.sparkContext.applicationId, secrets.token_hex(32))


def replace_pii(docs: DataFrame, *, text_col: str = "text", secret: str | None = None) -> DataFrame:
    """All columns of ``docs`` with ``text_col`` replaced and ``n_entities``, the number of replaced entities.

    Null and empty texts and texts without entities stay as they are, with 0.  Equal texts get equal results,
    so rows may repeat.  An added column replaces a column of the same name.  Rows without entities aren't
    shuffled.  ``secret`` is the key of the surrogates; without one ``key_of`` the session serves.
    """
    secret = secret or key_of(docs.sparkSession)
    text = F.col(text_col)
    has = has_entities(text)
    clean = docs.where(~has).withColumn("n_entities", F.lit(0).cast("long"))
    held = docs.where(has).withColumn("__digest", F.md5(text.cast("binary")))
    everything = f"{ENTITY}|{MENTION}"
    matches = lambda pattern: F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = F.when(has_name(text), matches(everything)).otherwise(matches(ENTITY))
    texts = materialize(held.select("__digest", found.alias("__found")).dropDuplicates(["__digest"]))
    pieced = materialize(texts.select("__digest", F.posexplode("__found").alias("i", "match")).select("__digest", "i", F.posexplode(pieces(F.col("match"))).alias("j", "p")).select("__digest", "i", "j", "p.*"))
    parts = mentions_resolved(pieced)
    value = surrogates(resolved(parts), secret).withColumn("kind", F.regexp_replace("kind", "^(name-.*-)[mfx]$", "$1g"))
    literal = parts.where("kind is null").withColumn("value", F.lit(None).cast("string"))
    known = parts.where("kind is not null").join(value, ["kind", "key"], "left").unionByName(literal)
    out = F.when(F.col("value").isNull(), F.col("raw")).otherwise(formatted(F.col("kind"), F.col("raw"), F.col("value")))
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(c, "out"))), lambda x: x["out"]), "")
    by_match = known.withColumn("out", out).groupBy("__digest", "i").agg(joined("j").alias("out"), F.count("kind").alias("n"))
    by_text = by_match.groupBy("__digest").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "out"))), lambda x: x["out"]).alias("__out"), F.sum("n").alias("n_entities"))
    between = F.when(has_name(text), F.split(text, everything, -1)).otherwise(F.split(text, ENTITY, -1))
    rebuilt = F.array_join(F.zip_with(between, F.concat("__out", F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    changed = held.drop("n_entities").join(by_text, "__digest").withColumn(text_col, rebuilt)
    return changed.select(*clean.columns).union(clean)
