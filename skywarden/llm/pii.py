"""Personal data: detected entities become keyed surrogates of the same form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skywarden.llm.common import drop_staged, staged, text_of

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_TITLES = {"m": r"Mr\.|Herr|Monsieur|Señor|Господин", "f": r"Mrs\.|Ms\.|Frau|Madame|Señora|Госпожа",
           "x": r"Dr\.|Prof\."}

#: Kinds of entities, in the order in which they are tried at a place.  Each
#: starts at the edge of a word, so that a long run is looked at once.
PATTERNS = {
    "email": r"(?<![\w.%+\-])[A-Za-z0-9][A-Za-z0-9._%+\-]*+@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)+",
    "secret": r"(?<!\w)(?i:password|passwd|pwd|secret|token|api_?key)\s{0,3}[=:]\s{0,3}[\"']?"
              r"(?=[A-Za-z+/_\-]{0,200}\d)[A-Za-z0-9+/_\-]{8,}+",
    "key": r"(?<!\w)(?:A[KS]IA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36})(?!\w)",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "ip": rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)",
    "phone": r"(?<![\w+])\+\d{1,3}(?:[ .\-]?\(\d{1,4}\))?(?:[ .\-]?\d{2,4}){2,4}(?!\d)"
             r"|(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\w.\-])\d{3}[.\-]\d{3}[.\-]\d{4}(?![\w\-])",
    "ssn": r"(?<![\w.\-])\d{3}-\d{2}-\d{4}(?![\w\-])",
    "card": r"(?<![\w.\-])\d{4}(?:[ \-]?\d{4}){2}[ \-]?\d{1,7}(?![\w\-])",
    "name": rf"(?<!\w)(?:{'|'.join(_TITLES.values())})(?: \p{{Lu}}[\p{{L}}'’\-]+){{1,3}}",
}
#: What all of them share, a first character at the edge of a word, is tested once and first.
ANY = r"(?<!\w)(?=[A-Za-z0-9+(Г])(?:" + "|".join(f"(?:{p})" for p in PATTERNS.values()) + ")"

# Given names by script and gender, and the parts that surnames are made of.
_GIVEN = {
    "latin": {"m": "Adam Boris Carl Denis Emil Felix Georg Hugo Ivan Jonas Karl Leo Martin Nils Oscar Paul".split(),
              "f": "Alma Berta Clara Doris Emma Flora Greta Helen Irma Julia Karin Laura Maria Nora Olga Paula".split(),
              "x": "Alex Kim Robin Sam Toni Chris Jo Sascha".split()},
    "cyrillic": {"m": "Антон Борис Виктор Глеб Денис Егор Иван Кирилл".split(),
                 "f": "Анна Вера Галина Дарья Елена Ирина Мария Ольга".split(), "x": "Саша Женя Валя Шура".split()},
}
_SURNAME = {
    "latin": ("Bar Cor Dal Fen Gar Hal Kel Lor Mar Nor Pel Ram Sol Tor Val Wen".split(),
              "a be di do en er i la li mo na o ri sa ti u".split(),
              "berg dale feld ford holm land ler man mann mont nik rod ston ton ville wick".split()),
    "cyrillic": ("Бар Вол Гор Дол Зам Кор Лес Мар".split(), "а е и о у я ен ин".split(), "ов ев ин ский цкий енко ук ич".split()),
}


def kind_of(entity: Column) -> Column:
    return F.coalesce(*[F.when(entity.rlike(f"^(?:{p})$"), F.lit(k)) for k, p in PATTERNS.items()])


def _digest(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), *[p.cast("string") for p in parts]), 512)


def _byte(digest: Column, i: Column) -> Column:
    """The i-th byte, from 0, of a digest of 64 bytes that starts anew at its end."""
    return F.conv(F.substr(digest, i % 64 * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _drawn(digest: Column, at: int, words: list[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), _byte(digest, F.lit(at)) % len(words) + 1)


def _same_form(text: Column, digest: Column) -> Column:
    """Digits for digits, letters for letters of the same case (a to f among themselves), the rest as it is."""
    def one(i: Column) -> Column:
        c, b = F.substr(text, i + 1, F.lit(1)), _byte(digest, i)
        letter = lambda first, n: F.char(F.lit(first) + b % n)
        return F.when(c.rlike("[0-9]"), (b % 10).cast("string")).when(c.rlike("[a-f]"), letter(97, 6)) \
            .when(c.rlike("[g-z]"), letter(103, 20)).when(c.rlike("[A-F]"), letter(65, 6)) \
            .when(c.rlike("[G-Z]"), letter(71, 20)).otherwise(c)
    return F.when(F.length(text) > 0, F.array_join(F.transform(F.sequence(F.lit(0), F.length(text) - 1), one), "")) \
        .otherwise("")


def _with_check_digit(body: Column) -> Column:
    """A card number made valid by its last digit."""
    digits = F.regexp_replace(body, "[^0-9]", "")

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)
    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add)
    return F.concat(body, ((10 - total % 10) % 10).cast("string"))


def surrogate(entity: Column, kind: Column, salt: Column, surname: Column, key: str) -> Column:
    """A replacement of the same kind and form; ``salt`` 0, 1, ... gives further ones.

    Each salt draws from more values than the one before, so that no number
    of entities uses them up: a person has one more given name per salt;
    mail names and secrets get a further letter per salt from 2 on, the
    other kinds a further digit from 8 on, where their own form is full.

    Kept are the country code of a phone, the country of an IBAN, the
    prefix of a key, the name of a secret, and the title of a person, whose
    given names follow its gender and script.  A mail domain has one
    surrogate for all its addresses, below the reserved domain .example.
    """
    digest = _digest(key, kind, entity, salt)
    more = lambda like, since: _same_form(
        F.repeat(F.lit(like), F.greatest(F.lit(0), salt - since + 1)), _digest(key, F.lit("more"), entity, salt))
    letters, digits = more("g", 2), more("0", 8)

    def after(prefix: str) -> Column:
        head = F.regexp_extract(entity, prefix, 0)
        return F.concat(head, _same_form(F.substr(entity, F.length(head) + 1, F.length(entity)), digest))
    domain = F.regexp_extract(entity, r"@(.*)\.[^.]*$", 1)
    email = F.concat(_same_form(F.regexp_extract(entity, "^([^@]*)@", 1), digest), letters, F.lit("@"),
                     _same_form(domain, _digest(key, F.lit("domain"), F.lower(domain))), F.lit(".example"))
    ip = F.concat_ws(".", *[(lo + _byte(digest, F.lit(i)) % n).cast("string")
                            for i, (lo, n) in enumerate([(1, 223), (0, 256), (0, 256), (1, 254)])])
    title = F.regexp_extract(entity, r"^(\S+) ", 1)
    given = F.regexp_extract(entity, r"^\S+ (.*) \S+$", 1)
    gender = F.when(title.rlike(f"^(?:{_TITLES['m']})$"), "m").when(title.rlike(f"^(?:{_TITLES['f']})$"), "f").otherwise("x")
    pool = F.coalesce(*[F.when((_script(entity) == s) & (gender == g), F.array(*map(F.lit, words)))
                        for s, by in _GIVEN.items() for g, words in by.items()])
    pick = F.array_join(F.transform(F.sequence(F.lit(0), salt),
                                    lambda i: F.element_at(pool, _byte(digest, i) % F.size(pool) + 1)), " ")
    name = F.concat_ws(" ", title, F.when(given != "", pick), surname)
    return F.when(kind == "email", email).when(kind == "name", name).when(kind == "ip", F.concat(ip, digits)) \
        .when(kind == "card", _with_check_digit(F.concat(F.substr(after("^$"), F.lit(1), F.length(entity) - 1), digits))) \
        .when(kind == "secret", F.concat(after("^[^=:]*[=:]\\s*[\"']?"), letters)) \
        .otherwise(F.concat(F.when(kind == "phone", after(r"^\+\d{1,3}(?=[ .(\-])|^")).when(kind == "iban", after("^[A-Z]{2}"))
                            .when(kind == "key", after("^(?:A[KS]IA|gh._)")).otherwise(after("^$")), digits))


def _script(name: Column) -> Column:
    return F.when(name.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")


def _surname(name: Column, salt: Column, key: str) -> Column:
    """A surname of three parts, and of two more in the middle for each salt: the space grows with the salt."""
    digest = _digest(key, F.lit("surname"), F.lower(name), salt)

    def made(first: list[str], middle: list[str], end: list[str]) -> Column:
        def pair(i: Column) -> Column:
            return F.concat(*[F.element_at(F.array(*map(F.lit, words)), _byte(digest, 2 * i + at) % len(words) + 1)
                              for at, words in ((1, [x.lower() for x in first]), (2, middle))])
        more = F.when(salt > 0, F.array_join(F.transform(F.sequence(F.lit(1), salt), pair), "")).otherwise("")
        return F.concat(_drawn(digest, 0, first), _drawn(digest, 1, middle), more, _drawn(digest, 2, end))
    return F.coalesce(*[F.when(_script(name) == s, made(*parts)) for s, parts in _SURNAME.items()])


def distinct_surrogates(entities: DataFrame, make: Callable[[Column], Column]) -> DataFrame:
    """``entities`` (entity, ...) with surrogate, no two alike and none an entity itself.

    ``make`` gives the surrogate for a salt.  Where several entities share
    one, the first keeps it and the others draw again, as does an entity
    whose surrogate occurs in the texts.
    """
    # Drawing costs far more than the rows' bytes tell: keep it from being put into few tasks.
    entities = entities.repartition(int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions")), "entity")
    drawn = staged(entities.withColumn("salt", F.lit(0)).withColumn("surrogate", make(F.col("salt"))), "pii-drawn")
    while True:
        first = drawn.groupBy("surrogate").agg(F.min("entity").alias("first"), F.count("*").alias("n")).where("n > 1")
        shared = drawn.join(first, "surrogate").where("entity != first").select("entity")
        real = drawn.join(drawn.select(F.col("entity").alias("surrogate")), "surrogate", "left_semi").select("entity")
        again = staged(shared.unionByName(real).distinct().withColumn("again", F.lit(1)), "pii-again")
        if again.isEmpty():
            return drawn.drop("salt")
        salted = drawn.join(again, "entity", "left").withColumn("salt", F.col("salt") + F.coalesce("again", F.lit(0)))
        done, drawn = drawn, staged(salted.drop("again", "surrogate").withColumn("surrogate", make(F.col("salt"))),
                                    "pii-drawn")
        drop_staged(done)


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(entity, surrogate) for distinct entities; a surname has one surrogate wherever it occurs."""
    found = staged(entities.select("entity").distinct().withColumn("kind", kind_of(F.col("entity"))).withColumn(
        "last", F.when(F.col("kind") == "name", F.regexp_extract("entity", r" (\S+)$", 1))), "pii-entities")
    last = found.where("last is not null").select(F.col("last").alias("entity")).distinct()
    last = distinct_surrogates(last, lambda salt: _surname(F.col("entity"), salt, key)) \
        .select(F.col("entity").alias("last"), F.col("surrogate").alias("surname"))
    found = found.join(last, "last", "left")
    return distinct_surrogates(found, lambda salt: surrogate(F.col("entity"), F.col("kind"), salt, F.col("surname"), key)) \
        .select("entity", "surrogate")


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with the entities of ``text`` replaced, and n_entities added.

    The same entity has the same surrogate in all documents, and different
    entities different ones (:func:`surrogates`); both depend on ``key``
    and not on the order of the rows.  Texts without entities pass as they
    are and are not shuffled.  Copies of a text are treated once.

    A null or empty text has no entities and stays as it is.  Rows are
    treated one by one, whatever their doc_id.  Other columns pass, one
    named n_entities is replaced.
    """
    docs = docs.drop("n_entities")
    hit = F.coalesce(F.col("text").rlike(ANY), F.lit(False))
    texts = docs.where(hit).select(F.md5("text").alias("k"), F.regexp_extract_all("text", F.lit(ANY), F.lit(0)).alias("all"))
    texts = staged(texts.dropDuplicates(["k"]), "pii-texts")
    marks = texts.select("k", F.posexplode("all").alias("pos", "entity"))
    known = staged(surrogates(marks, key), "pii-known")
    lists = marks.join(known, "entity").groupBy("k").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "surrogate"))), lambda x: x["surrogate"]).alias("__new"))
    lists = staged(lists.withColumnRenamed("k", "__k"), "pii-lists")
    own = docs.where(hit).withColumn("__k", F.md5("text")).join(lists, "__k") \
        .withColumn("__between", F.split("text", ANY, -1))
    text = F.array_join(F.transform("__between", lambda x, i: F.concat(x, F.coalesce(F.get("__new", i), F.lit("")))), "")
    own = own.withColumn("text", text).withColumn("n_entities", F.size("__new").cast("long"))
    clean = docs.where(~hit).withColumn("n_entities", F.lit(0).cast("long"))
    return clean.unionByName(own.select(*clean.columns))
