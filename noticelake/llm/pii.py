"""Operator 8, PII replaced by surrogates (DataFrame functions only).

Detected: e-mail and IP addresses, phone, card, social security and bank account numbers, names after a title, names
that begin with a known given name, and, in a text that holds such a name, every later mention of its words alone
("Mr John Smith ... Smith"). Entities are numbers, addresses and the words of names (a given name or a surname, its
script and, where the language marks it, its gender), so a person keeps one surrogate with and without title, in
full and in part, in every document.

Every entity gets a surrogate from a keyed hash of its canonical form. Surrogates match the type: digits replace
digits in the mention's own punctuation, none is copied; cards pass the Luhn test and accounts the mod-97 test and
keep their country; octets stay octets; an e-mail stays one, in the script of its local part; names keep title,
number of words, script (Latin, Cyrillic, Greek), gender and capitals.

Collision checks run over the different entities of the whole table: where two would get one surrogate, or a
surrogate would equal a real entity, all but one try the next hash, until none collide. Later tries lengthen the
surrogate, so that a short form that is used up ends as well. Only entities past their first try need more than their
own row to be replaced: without any, texts are rewritten where they are read and never shuffled; with some, the texts
that hold them learn the number of the try by a join.

Defined cases: a null text stays null; repeated rows and null ids are kept; texts without entities are left as they
are; an empty table gives an empty result; only the text enters the work, and all columns are kept, whatever their
names, but for one named like the result's own (``found_col``), which that replaces. The key has no default: who knows it can
recompute surrogates. The query reads it from ``spark.noticelake.surrogates.key`` and draws one where it is unset.
"""

from __future__ import annotations

from secrets import token_hex

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticelake.llm.common import checkpoint, table

#: Titles before a name, with their gender (fixed values).
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Господин", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Госпожа", "Κυρία")

#: Given names by script and gender, which are found without a title and which surrogates are taken from, and syllables for surnames.
GIVEN = {
    ("latin", "m"): "Adam Alexander Andrew Anthony Boris Carl Carlos Daniel David Denis Emil Felix Georg George Hans Henry Hugo Ivan James Jean John Jonas Joseph Juan Karol Leo Martin Michael Niklas Oskar Paul Pavel Peter Pierre Robert Stephen Thomas William".split(),
    ("latin", "f"): "Ada Alice Anna Barbara Berta Carmen Caroline Clara Dora Elizabeth Emily Emma Flora Gerda Hana Helen Ingrid Irma Jana Jennifer Julia Karen Klara Laura Lena Linda Lucia Margaret Maria Marie Marta Mary Nina Olga Patricia Petra Sarah Sophie Susan".split(),
    ("cyrillic", "m"): "Андрей Борис Виктор Глеб Денис Егор Захар Иван Кирилл Лев Марк Никита Олег Павел Роман Семён".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Жанна Зоя Инна Кира Лариса Мария Нина Ольга Полина Рита Софья".split(),
    ("greek", "m"): "Άρης Βασίλης Γιώργος Δημήτρης Ηλίας Θάνος Ιάσων Κώστας Λευτέρης Μάνος Νίκος Πέτρος Σπύρος Στέλιος Τάσος Φίλιππος".split(),
    ("greek", "f"): "Άννα Βάσω Γεωργία Δήμητρα Ειρήνη Ελένη Ζωή Θάλεια Ιωάννα Κατερίνα Λίνα Μαρία Νίκη Ρένα Σοφία Χαρά".split(),
}
SYLLABLES = {
    "latin": "ba de fi go hu ka le mi no pu ra se ti vo wu za".split(),
    "cyrillic": "ба де фи го ху ка ле ми но пу ра се ти во ша за".split(),
    "greek": "βα δε φι γο χυ κα λε μι νο πυ ρα σε τι ζο θυ ξα".split(),
}

_LOCAL = r"[\p{L}\p{N}._%+-]"
#: Host names have at most 127 labels (fixed value). Loops over groups are bounded or possessive: others recurse once a turn.
EMAIL = rf"(?<!{_LOCAL}){_LOCAL}++@[\p{{L}}\p{{N}}-]+(?:\.[\p{{L}}\p{{N}}-]+){{0,125}}\.\p{{L}}{{2,}}"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
IP = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?[0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
CARD = r"(?<![0-9])(?:[0-9]{4}(?:[\x20-][0-9]{4}){3}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5}|[0-9]{13,19})(?![0-9])"
PHONE = r"(?<![0-9+])(?:\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{1,4}\)[\x20.-]?)?[0-9]{2,4}(?:[\x20.-]?[0-9]{2,4}){1,3}|\([0-9]{3}\)\x20?[0-9]{3}-[0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9])"
IBAN = r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"
_TITLES = "|".join(MALE + FEMALE)
_GIVEN = "|".join(n for names in GIVEN.values() for n in names)
_WORD = r"\p{Lu}\p{L}*+(?:['’-]\p{Lu}\p{L}*+)*+"
TITLE = rf"(?:{_TITLES})\.?\x20"
NAME = rf"(?<!\p{{L}})(?=\p{{Lu}})(?:{TITLE}{_WORD}(?:\x20{_WORD}){{0,2}}|(?:{_GIVEN})(?:\x20{_WORD}){{1,2}})(?!\p{{L}})"

#: In the order in which they are tried at a place; a mention's kind is the first that it matches as a whole.
KINDS = (("email", EMAIL), ("ip", IP), ("ssn", SSN), ("iban", IBAN), ("card", CARD), ("phone", PHONE), ("name", NAME))
ANY = "|".join(f"(?:{p})" for _, p in KINDS)
#: From these tries on a given name gets syllables, and a number is a digit longer with each (a surname: once, by six syllables).
GIVEN_TAIL = 3
LENGTHEN = 5
#: Letters of e-mail surrogates, one for each hexadecimal digit.
LETTERS = {"latin": "bcdfghjklmnpqrst", "cyrillic": "бвгджзклмнпрстфх", "greek": "βγδζθκλμνξπρστφχ"}

#: What every mention holds, cheap to look for.
HINT = rf"[0-9@]|(?<!\p{{L}})(?=\p{{Lu}})(?:{_TITLES}|{_GIVEN})"


def _let(value: Column, f) -> Column:
    """f(value), with value worked out once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _extend(items: Column, keep: str, **more) -> Column:
    """Array of structs with further fields; each step's fields are worked out once and read by the next."""
    return F.transform(items, lambda x: F.struct(*(x[k].alias(k) for k in keep.split()), *(f(x).alias(n) for n, f in more.items())))


def kind_of(mention: Column) -> Column:
    """The kind of a whole mention, from marks that tell the kinds apart."""
    return (
        F.when(mention.contains("@"), "email")
        .when(mention.rlike(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$"), "ip")
        .when(mention.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
        .when(mention.rlike(r"^[A-Z]{2}[0-9]"), "iban")
        .when(mention.rlike(r"^(?:[0-9]{4}(?:[\x20-][0-9]{4}){3}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5}|[0-9]{13,19})$"), "card")
        .when(mention.rlike(r"^[0-9+(]"), "phone")
        .otherwise("name")
    )


def _form(m: Column, kind: Column) -> Column:
    """What all mentions of a number or address share."""
    return F.when(kind == "email", F.lower(m)).when(kind == "ip", m).when(kind == "phone", F.regexp_replace(m, r"[^0-9+]", "")).otherwise(F.regexp_replace(m, r"[^0-9A-Z]", ""))


def _script(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic").when(text.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _name_parts(mention: Column) -> Column:
    """array<struct<w, entity>> of a name with title or known given name: name|script|g or s|gender|word in lower case."""
    male, female = ("|".join(MALE), "|".join(FEMALE))
    known = "|".join(n for (_, gender), names in GIVEN.items() if gender == "f" for n in names)
    gender = F.when(mention.rlike(rf"^(?:{male})\.?\x20"), "m").when(mention.rlike(rf"^(?:(?:{female})\.?|{known})\x20"), "f").otherwise("m")
    words = F.split(F.regexp_replace(mention, rf"^{TITLE}", ""), " ")
    part = lambda x: F.transform(
        x["words"],
        lambda w, i: F.struct(
            w.alias("w"),
            F.when(i < F.size(x["words"]) - 1, F.concat_ws("|", F.lit("name"), x["script"], F.lit("g"), x["gender"], F.lower(w)))
            # Only the Cyrillic surname shows the gender.
            .otherwise(F.concat_ws("|", F.lit("name"), x["script"], F.lit("s"), F.when(x["script"] == "cyrillic", x["gender"]).otherwise("x"), F.lower(w)))
            .alias("entity"),
        ),
    )
    return _let(F.struct(words.alias("words"), gender.alias("gender"), _script(mention).alias("script")), part)


def _own_words(found: Column) -> Column:
    """map<word, entity>: the words of three letters or more of the names in a list of mentions, also in capitals."""
    names = F.filter(found, lambda m: kind_of(m) == "name")
    words = F.filter(F.flatten(F.transform(names, _name_parts)), lambda p: F.length(p["w"]) > 2)
    words = F.sort_array(_let(words, lambda a: F.concat(a, F.transform(a, lambda p: F.struct(F.upper(p["w"]).alias("w"), p["entity"].alias("entity"))))))
    return F.map_from_entries(_let(words, lambda a: F.filter(a, lambda x, i: (i == 0) | (F.get(a, i - 1)["w"] != x["w"]))))


def described(text: Column) -> Column:
    """struct<pattern, items>: what cuts the text at its mentions, and array<struct<m, kind, parts: array<struct<w, entity>>>>."""
    none = F.array().cast("array<string>")
    first = F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(none)

    def again(r: Column) -> Column:
        words = F.map_keys(r["own"])
        known = F.concat(F.lit("(?:"), F.array_join(words, "|"), F.lit(r")(?!\p{L})"))
        own = F.concat(F.lit(ANY + r"|(?:(?<!\p{L})"), known, F.lit(r"(?:\x20"), known, F.lit(r")*+)"))
        return F.struct(r["own"].alias("own"), r["found"].alias("found"), F.when(F.size(words) > 0, own).otherwise(F.lit(ANY)).alias("pattern"))

    def told(r: Column) -> Column:
        found = F.when(F.size(r["own"]) > 0, F.regexp_extract_all(text, r["pattern"], F.lit(0))).otherwise(r["found"])
        items = F.transform(found, lambda m: F.struct(m.alias("m"), kind_of(m).alias("kind")))
        single = lambda x: F.array(F.struct(x["m"].alias("w"), F.concat_ws("|", x["kind"], _form(x["m"], x["kind"])).alias("entity")))
        whole = lambda x: x["m"].rlike(rf"^(?:{TITLE}|(?:{_GIVEN})\x20)")
        words = lambda x: F.transform(F.split(x["m"], " "), lambda w: F.struct(w.alias("w"), F.try_element_at(r["own"], w).alias("entity")))
        items = _extend(items, "m kind", parts=lambda x: F.when(x["kind"] != "name", single(x)).when(whole(x), _name_parts(x["m"])).otherwise(words(x)))
        return F.struct(r["pattern"].alias("pattern"), items.alias("items"))

    held = _let(first, lambda f: F.struct(f.alias("found"), _own_words(f).alias("own")))
    return _let(_let(held, again), told)


def entities_of(text: Column) -> Column:
    """array<string>: the entities of a text, none for null."""
    return F.coalesce(F.flatten(F.transform(described(text)["items"], lambda x: x["parts"]["entity"])), F.array().cast("array<string>"))


def _hash(key: str, entity: Column, attempt: Column) -> Column:
    """64 hexadecimal digits."""
    return F.sha2(F.concat_ws("\x1f", F.lit(key), entity, attempt.cast("string")), 256)


def _number(h: Column, at: int, n: int) -> Column:
    return F.conv(F.substring(h, at, n), 16, 10).cast("int")


def _pick(names: list[str], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), number % len(names) + 1)


def _name_word(x: Column) -> Column:
    """The surrogate of a given name or surname, in lower case. x: h, fields (of the entity), attempt."""
    h, script, role, gender = x["h"], x["fields"][1], x["fields"][2], x["fields"][3]
    out = F.lit("")
    for name, syllables in SYLLABLES.items():
        six = F.concat(*(_pick(syllables, _number(h, 9 + k, 1)) for k in range(6)))
        tail = F.concat(*(_pick(syllables, _number(h, 17 + k, 1)) for k in range(6)))
        surname = F.when(x["attempt"] < LENGTHEN, six).otherwise(F.concat(six, tail))
        if name == "cyrillic":
            surname = F.concat(surname, F.when(gender == "f", "нова").otherwise("нов"))
        given = F.when(gender == "f", _pick(GIVEN[name, "f"], _number(h, 1, 6))).otherwise(_pick(GIVEN[name, "m"], _number(h, 1, 6)))
        given = F.when(x["attempt"] < GIVEN_TAIL, given).when(x["attempt"] < LENGTHEN, F.concat(given, F.substring(tail, 1, 4))).otherwise(F.concat(given, tail))
        out = F.when(script == name, F.when(role == "g", given).otherwise(surname)).otherwise(out)
    return F.lower(out)


def _digits(h: Column, at, n) -> Column:
    return F.substring(F.translate(h, "abcdef", "012345"), F.lit(at), n)


def _first_digit(h: Column) -> Column:
    return (_number(h, 1, 2) % 9 + 1).cast("string")


def _luhn(body: Column) -> Column:
    """The digit that completes a card number."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(body, i, F.lit(1)).cast("int")
        twice = (F.length(body) - i) % 2 == 0
        return total + F.when(twice, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.length(body)), F.lit(0), add)
    return ((10 - total % 10) % 10).cast("string")


def _account(form: Column, h: Column) -> Column:
    """Country, check digits, and digits for digits and letters for letters of the rest."""
    nibble = lambda i: F.substring(h, i + 1, F.lit(1))
    like = lambda c, i: F.when(c.rlike("[0-9]"), F.translate(nibble(i), "abcdef", "012345")).otherwise(F.translate(nibble(i), "0123456789abcdef", "ABCDEFGHIJKLMNOP"))
    rest = F.array_join(F.transform(F.filter(F.split(F.substring(form, F.lit(5), F.length(form)), ""), lambda c: c != ""), like), "")
    country = F.substring(form, 1, 2)

    def checked(r: Column) -> Column:
        step = lambda acc, c: F.when(c.rlike("[0-9]"), (acc * 10 + c.cast("int")) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97)
        rest = F.aggregate(F.filter(F.split(F.concat(r, country, F.lit("00")), ""), lambda c: c != ""), F.lit(0), step)
        return F.concat(country, F.lpad((98 - rest).cast("string"), 2, "0"), r)

    return _let(rest, checked)


def _new_form(x: Column) -> Column:
    h, form, kind = x["h"], x["form"], x["kind"]
    more = F.greatest(F.lit(0), x["attempt"].cast("int") - LENGTHEN + 1)
    # A sign before the digits stays; the first digit is never zero.
    sign = F.regexp_extract(form, r"^([^0-9]*)", 1)
    drawn = F.concat(sign, _first_digit(h), _digits(h, 3, F.length(form) - F.length(sign) - 1 + more))
    card = _let(F.concat(_first_digit(h), _digits(h, 3, F.length(form) - 2 + more)), lambda b: F.concat(b, _luhn(b)))
    # Areas from 100 to 599; groups and serials that are not zero.
    ssn = F.concat((_number(h, 1, 2) % 5 + 1).cast("string"), _digits(h, 3, F.lit(3)), (_number(h, 7, 2) % 9 + 1).cast("string"), _digits(h, 9, F.lit(3) + more), (_number(h, 33, 2) % 9 + 1).cast("string"))
    octets = F.concat_ws(".", *((_number(h, 1 + 4 * k, 4) % 254 + 1).cast("string") for k in range(4)))
    local, host = F.substring(h, 1, 10), F.translate(F.substring(h, 11, 8), "0123456789abcdef", LETTERS["latin"])
    script = _script(F.substring_index(form, "@", 1))
    spelt = F.lit("")
    for name, letters in LETTERS.items():
        spelt = F.when(script == name, F.translate(local, "0123456789abcdef", letters)).otherwise(spelt)
    email = F.concat(spelt, F.lit("@"), host, F.lit(".example"))
    return F.when(kind == "email", email).when(kind == "ip", octets).when(kind == "name", _name_word(x)).when(kind == "card", card).when(kind == "iban", _account(form, h)).when(kind == "ssn", ssn).otherwise(drawn)


def _drawn(items: Column, keep: str, key: str) -> Column:
    """items: structs with entity and attempt. Adds new: the form of the surrogate, and as: the entity that it would be."""
    items = _extend(items, keep, h=lambda x: _hash(key, x["entity"], x["attempt"]), kind=lambda x: F.substring_index(x["entity"], "|", 1), form=lambda x: F.regexp_extract(x["entity"], r"^[a-z]+\|(?s)(.*)$", 1))
    items = _extend(items, f"{keep} h kind form", fields=lambda x: F.split(x["entity"], r"\|"))
    items = _extend(items, f"{keep} kind fields", new=_new_form)
    real = lambda x: F.when(x["kind"] == "name", F.concat_ws("|", F.slice(x["fields"], 1, 4), x["new"])).otherwise(F.concat_ws("|", x["kind"], x["new"]))
    return _extend(items, f"{keep} new", real=real)


def _cased(word: Column, new: Column) -> Column:
    return F.when((word == F.upper(word)) & (F.length(word) > 1), F.upper(new)).otherwise(F.initcap(new))


def _worded(x: Column) -> Column:
    """The surrogate in the mention's own spelling. x: m, kind, parts (w, new)."""
    m, new = x["m"], x["parts"][0]["new"]
    named = F.concat(F.regexp_extract(m, rf"^({TITLE})?", 0), F.array_join(F.transform(x["parts"], lambda p: _cased(p["w"], p["new"])), " "))
    # The nth digit, letter or plus of the surrogate takes the place of the mention's nth.
    sign = r"[^0-9A-Z+]"
    spelt = F.array_join(
        F.transform(
            F.split(m, ""),
            lambda c, i: F.when(c.rlike(sign), c).otherwise(F.substring(new, F.length(F.regexp_replace(F.substring(m, F.lit(1), i + 1), sign, "")), F.lit(1))),
        ),
        "",
    )
    spelt = F.concat(spelt, F.substring(new, F.length(F.regexp_replace(m, sign, "")) + 1, F.length(new)))
    email = F.when(m == F.upper(m), F.upper(new)).otherwise(new)
    return F.when(x["kind"] == "name", named).when(x["kind"] == "email", email).when(x["kind"] == "ip", new).otherwise(spelt)


def rewritten(text: Column, key: str, attempt) -> Column:
    """struct<text, mentions_found>; attempt: from an entity to the number of its try."""

    def made(r: Column) -> Column:
        # Each entity of the text is drawn once, however often it is mentioned.
        each = F.array_distinct(F.flatten(F.transform(r["items"], lambda x: F.transform(x["parts"], lambda p: p["entity"]))))
        drawn = _drawn(F.transform(each, lambda e: F.struct(e.alias("entity"), attempt(e).alias("attempt"))), "entity attempt", key)
        known = F.map_from_entries(F.transform(drawn, lambda d: F.struct(d["entity"].alias("entity"), d["new"].alias("new"))))
        return _let(F.struct(r["pattern"].alias("pattern"), r["items"].alias("items"), known.alias("known")), worded)

    def worded(r: Column) -> Column:
        parts = lambda x: F.transform(x["parts"], lambda p: F.struct(p["w"].alias("w"), F.try_element_at(r["known"], p["entity"]).alias("new")))
        items = F.transform(r["items"], lambda x: _let(F.struct(x["m"].alias("m"), x["kind"].alias("kind"), parts(x).alias("parts")), lambda y: F.struct(y["kind"].alias("kind"), _worded(y).alias("new"))))
        return _let(F.struct(r["pattern"].alias("pattern"), items.alias("items")), joined)

    def joined(r: Column) -> Column:
        new = F.concat(F.transform(r["items"], lambda x: x["new"]), F.array(F.lit("")))
        parts = F.zip_with(F.split(text, r["pattern"], -1), new, lambda gap, s: F.concat(gap, s))
        return F.struct(F.when(F.size(r["items"]) > 0, F.array_join(parts, "")).otherwise(text).alias("text"), F.transform(r["items"], lambda x: x["kind"]).alias("mentions_found"))

    none = F.struct(text.alias("text"), F.array().cast("array<string>").alias("mentions_found"))
    return F.when(text.isNull(), none).otherwise(_let(described(text), made))


def tries(entities: DataFrame, key: str) -> DataFrame:
    """``entities``: column entity, each once. Returns entity, attempt so that no two surrogates agree and none is an entity."""
    real = entities.select(F.col("entity").alias("known"))
    held = entities.withColumn("attempt", F.lit(0))
    while True:
        drawn = held.select(F.inline(_drawn(F.array(F.struct("entity", "attempt")), "entity attempt", key)))
        # Those settled in an earlier round keep their surrogate.
        place = F.row_number().over(Window.partitionBy("real").orderBy("attempt", "entity"))
        checked = drawn.withColumn("place", place).join(real, F.col("real") == F.col("known"), "left")
        held = checkpoint(checked.select("entity", "attempt", ((F.col("place") > 1) | F.col("known").isNotNull()).alias("clash")))
        if held.filter("clash").isEmpty():
            return held.drop("clash")
        held = held.select("entity", (F.col("attempt") + F.col("clash").cast("int")).alias("attempt"))


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", found_col: str = "mentions_found") -> DataFrame:
    """``docs`` with its text rewritten; the last column, ``found_col``, has the mentions' kinds in order.

    ``key`` is the secret that surrogates depend on; without it they cannot be recomputed.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    entities = checkpoint(rows.select(F.explode(entities_of(F.col("text"))).alias("entity")).distinct())
    again = tries(entities, key).filter("attempt > 0")
    if again.isEmpty():
        done = rows.select("row", rewritten(F.col("text"), key, lambda e: F.lit(0)).alias("done"))
    else:
        # Texts learn the tries of the entities they hold by their digest.
        keyed = rows.withColumn("digest", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)))
        held = keyed.select("digest", F.explode(entities_of(F.col("text"))).alias("entity")).distinct()
        tried = held.join(again, "entity").groupBy("digest").agg(F.map_from_entries(F.collect_list(F.struct("entity", "attempt"))).alias("tries"))
        done = keyed.join(tried, "digest", "left").select("row", rewritten(F.col("text"), key, lambda e: F.coalesce(F.try_element_at("tries", e), F.lit(0))).alias("done"))
    kept = [c for c in docs.columns if c != found_col]
    return done.select(*(F.col("done.text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in kept), F.col("done.mentions_found").alias(found_col))


def session_key(spark: SparkSession) -> str:
    """The key that the session names, or one drawn for this call."""
    return spark.conf.get("spark.noticelake.surrogates.key", None) or token_hex(16)


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), session_key(spark))
    count = lambda kind: F.size(F.filter("mentions_found", lambda k: k == kind)).cast("long")
    return done.select("doc_id", "text", *(count(kind).alias(f"n_{kind}") for kind, _ in KINDS))


QUERIES = {"op8_pii_surrogates": op8_pii_surrogates}

#: The patterns look behind, which the oracle's regular expressions cannot; tests compare with brute force.
ORACLES: dict[str, str] = {}
