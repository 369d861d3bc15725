"""PII surrogates: keyed, type-consistent replacements, in SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import store

# What is personal. One pattern, leftmost match first; kinds are told apart afterwards.
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IBAN = r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"
IP = r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])"
CARD = r"(?<![0-9A-Za-z])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![0-9A-Za-z])"
PHONE = r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
TITLE = {"m": r"Mr\.?|Sir|Herr|Monsieur|Señor|Sr\.|господин|Господин|Κύριος", "f": r"Mrs\.?|Ms\.?|Miss|Frau|Madame|Mme|Señora|Sra\.|госпожа|Госпожа|Κυρία"}
WORD = r"\p{Lu}\p{Ll}+(?:[-'’]\p{Lu}?\p{Ll}+)?"
NAME = rf"(?<![\p{{L}}])(?:{TITLE['f']}|{TITLE['m']}) (?:{WORD} )?{WORD}"
PII = "|".join(f"(?:{p})" for p in (EMAIL, IBAN, IP, CARD, PHONE, SSN, NAME))
#: Texts without any of these hold nothing personal: each pattern needs one.
_FIRST = "".join(sorted({title[0] for titles in TITLE.values() for title in titles.split("|")}))
HINT = rf"[@0-9]|(?=[{_FIRST}])(?:{TITLE['f']}|{TITLE['m']}) \p{{Lu}}"
# Letters of each script, and given names by gender and script.
SCRIPTS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}
VOWELS = {"latin": "aeiou", "cyrillic": "аеиоу", "greek": "αεηιου"}
GIVEN = {
    ("m", "latin"): "Adam Alan Bruno Carl David Erik Felix Hugo Ivan Jonas Karl Leon Marco Noah Oscar Paul Ralf Simon Tomas Victor".split(),
    ("f", "latin"): "Ada Alma Bella Clara Diana Elena Flora Greta Helen Irene Julia Karin Laura Maria Nora Olga Paula Rosa Sara Vera".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Никита Олег Павел Роман Семён Фёдор".split(),
    ("f", "cyrillic"): "Анна Вера Галина Дарья Елена Зоя Ирина Ксения Лариса Мария Нина Ольга Полина Раиса София Юлия".split(),
    ("m", "greek"): "Αλέξης Βασίλης Γιώργος Δημήτρης Ηλίας Θωμάς Κώστας Λουκάς Νίκος Πέτρος Στέλιος Φώτης".split(),
    ("f", "greek"): "Άννα Βάσω Γεωργία Δήμητρα Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Νίκη Σοφία Φωτεινή".split(),
}
KINDS = ("email", "iban", "ip", "card", "phone", "ssn", "surname", "given_m", "given_f")
NAMES = ("surname", "given_m", "given_f")
#: Rounds in which collisions are mended before the form of a value counts as exhausted.
MOST_ROUNDS = 60
TOKENS = "array<struct<prefix:string,kind:string,value:string>>"


def _full(pattern: str) -> str:
    return f"^(?:{pattern})$"


def _tokens(match: Column) -> Column:
    """The parts of a match that are replaced, each with the kept text before it."""
    def one(kind: str) -> Column:
        return F.array(F.struct(F.lit("").alias("prefix"), F.lit(kind).alias("kind"), match.alias("value")))

    out = None
    for kind, pattern in (("email", EMAIL), ("ip", IP), ("card", CARD), ("ssn", SSN), ("phone", PHONE), ("iban", IBAN)):
        hit = match.rlike(_full(pattern))
        out = F.when(hit, one(kind)) if out is None else out.when(hit, one(kind))
    title = F.regexp_extract(match, rf"^(?:{TITLE['f']}|{TITLE['m']})(?= )", 0)
    gender = F.when(title.rlike(_full(TITLE["f"])), "f").otherwise("m")
    words = F.split(F.substring(match, F.length(title) + 2, F.length(match)), " ")
    names = F.transform(words, lambda w, i: F.struct(
        F.when(i == 0, F.concat(title, F.lit(" "))).otherwise(" ").alias("prefix"),
        F.when(i == F.size(words) - 1, "surname").otherwise(F.concat(F.lit("given_"), gender)).alias("kind"), w.alias("value")))
    return out.otherwise(names)


def _found(text: Column) -> Column:
    hint = F.coalesce(text.rlike(HINT), F.lit(False))
    return F.when(hint, F.regexp_extract_all(text, F.lit(PII), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _bytes(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """64 keyed bytes as hexadecimal digits; without the key nobody can tell them."""
    inner = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, value, attempt.cast("string")), 512)
    return F.sha2(F.concat(F.lit(key), inner), 512)


def _draw(digits: Column, at: Column, below: Column | int) -> Column:
    """A number under ``below`` from the keyed bytes at a place."""
    piece = F.substring(digits, (at % 31) * 4 + 1, F.lit(4))
    below = F.lit(below) if isinstance(below, int) else below
    return (F.conv(piece, 16, 10).cast("int") + at) % below


def _letter(alphabet: str, n: Column) -> Column:
    return F.substring(F.lit(alphabet), n + 1, F.lit(1))


def _same_form(value: Column, digits: Column) -> Column:
    """Each letter and digit replaced by another of its script and case; other characters stay."""
    def one(c: Column, i: Column) -> Column:
        out = F.when(c.rlike("[0-9]"), _draw(digits, i, 10).cast("string"))
        for letters in SCRIPTS.values():
            small = _letter(letters, _draw(digits, i, len(letters)))
            out = out.when(F.lower(c).rlike(f"[{letters}]"), F.when(F.lower(c) == c, small).otherwise(F.upper(small)))
        return out.otherwise(c)
    return F.array_join(F.transform(F.split(value, ""), lambda c, i: F.when(c == "", c).otherwise(one(c, i))), "")


def _with_check_digit(number: Column) -> Column:
    """The last digit set so that a card number passes the Luhn check."""
    plain = F.regexp_replace(number, "[^0-9]", "")
    digits = F.transform(F.split(F.reverse(F.substring(plain, F.lit(1), F.length(plain) - 1)), ""),
                         lambda c: F.when(c == "", 0).otherwise(F.try_to_number(c, F.lit("9")).cast("int")))
    doubled = F.transform(digits, lambda d, i: F.when(i % 2 == 0, F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)).otherwise(d))
    check = (10 - F.aggregate(doubled, F.lit(0), lambda s, d: s + d) % 10) % 10
    return F.concat(F.substring(number, F.lit(1), F.length(number) - 1), check.cast("string"))


def _surname(value: Column, digits: Column, attempt: Column) -> Column:
    """A made name of the value's script: syllables, one more after every eighth attempt."""
    def made(script: str) -> Column:
        vowels = VOWELS[script]
        others = "".join(c for c in SCRIPTS[script] if c not in vowels)
        count = F.lit(3) + F.floor(attempt / 8).cast("int")
        parts = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.concat(
            _letter(others, _draw(digits, i * 2, len(others))), _letter(vowels, _draw(digits, i * 2 + 1, len(vowels)))))
        return F.initcap(F.array_join(parts, ""))
    return F.when(value.rlike(r"\p{IsCyrillic}"), made("cyrillic")).when(value.rlike(r"\p{IsGreek}"), made("greek")) \
        .otherwise(made("latin"))


def _given(value: Column, digits: Column, attempt: Column, gender: str) -> Column:
    """A known given name of gender and script; from the second attempt on with a second one."""
    def made(script: str) -> Column:
        names = F.array(*[F.lit(n) for n in GIVEN[gender, script]])
        more = F.lit(1) + F.ceil(attempt / 4).cast("int")
        picked = F.transform(F.sequence(F.lit(0), more - 1),
                             lambda i: F.element_at(names, _draw(digits, i, len(GIVEN[gender, script])) + 1))
        return F.array_join(picked, "-")
    return F.when(value.rlike(r"\p{IsCyrillic}"), made("cyrillic")).when(value.rlike(r"\p{IsGreek}"), made("greek")) \
        .otherwise(made("latin"))


def surrogate(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """The replacement of a value in one attempt."""
    digits = _bytes(key, kind, value, attempt)
    at = F.instr(value, "@")
    domain = F.substring(value, at + 1, F.length(value))
    top = F.regexp_extract(domain, r"\.[^.]*$", 0)
    host = F.substring(domain, F.lit(1), F.length(domain) - F.length(top))
    hidden = _same_form(host, _bytes(key, F.lit("domain"), F.lower(domain), F.lit(0)))
    email = F.concat(_same_form(F.substring(value, F.lit(1), at - 1), digits), F.lit("@"), hidden, top)
    octets = F.concat_ws(".", (_draw(digits, F.lit(0), 223) + 1).cast("string"),
                         *[_draw(digits, F.lit(i), 256).cast("string") for i in (1, 2)],
                         (_draw(digits, F.lit(3), 254) + 1).cast("string"))
    country = F.regexp_extract(value, r"^\+[0-9]{1,3}(?=[ .(-])|^[A-Z]{2}", 0)
    rest = F.concat(country, _same_form(F.substring(value, F.length(country) + 1, F.length(value)), digits))
    return (F.when(kind == "email", email).when(kind == "ip", octets)
            .when(kind == "card", _with_check_digit(_same_form(value, digits)))
            .when(kind.isin("phone", "iban"), rest).when(kind == "ssn", _same_form(value, digits))
            .when(kind == "given_m", _given(value, digits, attempt, "m"))
            .when(kind == "given_f", _given(value, digits, attempt, "f"))
            .otherwise(_surname(value, digits, attempt)))


def surrogates(values: DataFrame, key: str) -> DataFrame:
    """``(kind, value, surrogate)`` from distinct ``(kind, value)``: no two values of a kind share one.

    Nor is a surrogate a value that occurs itself. Values that lose a collision are drawn anew until none
    is left; winners keep theirs. Each round is a grouping by the surrogate, whose groups are tiny.
    """
    state = store(values.select("kind", "value", F.lit(0).alias("attempt"),
                                surrogate(key, F.col("kind"), F.col("value"), F.lit(0)).alias("surrogate"),
                                F.lit(False).alias("won")), "surrogates")
    taken = state.select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("real"))
    for _ in range(MOST_ROUNDS):
        order = Window.partitionBy("kind", "surrogate").orderBy(F.desc("won"), "value")
        judged = (state.join(taken, ["kind", "surrogate"], "left")
                  .withColumn("won", F.col("real").isNull() & (F.row_number().over(order) == 1)).drop("real"))
        judged = store(judged, "judged")
        lost = judged.where(~F.col("won"))
        if lost.isEmpty():
            return judged.select("kind", "value", "surrogate")
        attempt = F.col("attempt") + 1
        anew = F.struct(attempt.alias("attempt"), surrogate(key, F.col("kind"), F.col("value"), attempt).alias("surrogate"))
        kept = F.struct("attempt", "surrogate")
        state = store(judged.withColumn("s", F.when(F.col("won"), kept).otherwise(anew))
                      .select("kind", "value", "s.attempt", "s.surrogate", "won"), "surrogates")
    raise ValueError("a kind has more values than its form allows surrogates")


def _whole_words(names: Column) -> Column:
    """A pattern of the given names as whole words, longer ones before those that they start with."""
    return F.concat(F.lit(r"(?<![\p{L}\p{N}])(?=\p{Lu})(?:"), F.array_join(F.sort_array(names, asc=False), "|"), F.lit(r")(?![\p{L}\p{N}])"))


def _renamed(piece: Column) -> Column:
    """A piece of text with the document's names in it replaced, by its columns ``name`` and ``named``."""
    gaps, words = F.split(piece, F.col("name"), -1), F.regexp_extract_all(piece, F.col("name"), F.lit(0))
    new = F.zip_with(gaps, words, lambda gap, word: F.concat(gap, F.coalesce(F.col("named")[word]["surrogate"], F.lit(""))))
    return F.when(F.rlike(piece, F.col("name")), F.array_join(new, "")).otherwise(piece)


def replace_personal(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """The documents with personal data replaced in ``text_col``, and ``n_<kind>`` counts added.

    Names are found after a title; the names found in a document are then replaced wherever they stand in it as whole
    words, with the same surrogates. A word that is a given name and a surname there is taken as what it was first.
    The same value of a kind gets the same surrogate everywhere, names part by part, so that ``Mr Roe``
    stays the ``Mr John Roe`` of before; different values get different ones. Numbers keep
    their grouping and length, cards their check digit, phones their country, emails their shape and, per domain, one
    surrogate domain with the real last part; names keep gender (by their title) and script.

    Texts are read where they are; what is shuffled are the distinct values, the distinct lists of
    values, and the documents that hold some. Null and empty texts stay. Repeated rows change alike. An empty table
    gives no rows. Columns with a result's name are replaced.
    """
    counts = [f"n_{kind}" for kind in KINDS]
    names = [c for c in docs.columns if c.lower() not in counts]
    plain = docs.select(*[F.col("`" + c.replace("`", "``") + "`").alias(f"c{i}") for i, c in enumerate(names)])
    text = F.col(f"c{names.index(text_col)}").cast("string")
    read = plain.withColumn("found", _found(text)).withColumn("list", F.unhex(F.md5(F.to_json("found"))))
    lists = store(read.where(F.size("found") > 0).groupBy("list").agg(F.first("found").alias("found"))
                  .select("list", F.flatten(F.transform("found", _tokens)).alias("tokens")), "lists")
    parts = lists.select("list", F.posexplode("tokens").alias("at", "t")).select("list", "at", "t.kind", "t.value")
    known = surrogates(parts.select("kind", "value").distinct(), key)
    drawn = store(parts.join(known, ["kind", "value"]), "drawn")
    names_of = (drawn.where(F.col("kind").isin(*NAMES)).groupBy("list", "value")
                .agg(F.min(F.struct("at", "kind", "surrogate")).alias("first"))
                .groupBy("list").agg(F.map_from_entries(F.collect_list(F.struct("value", "first"))).alias("named"))
                .withColumn("name", _whole_words(F.map_keys("named"))))
    drawn = drawn.groupBy("list").agg(F.sort_array(F.collect_list(F.struct("at", "surrogate"))).alias("new"))
    drawn = drawn.join(lists, "list").join(names_of, "list", "left").withColumnRenamed("list", "of_list")
    none = read.where(F.size("found") == 0).withColumn("tokens", F.array().cast(TOKENS))
    some = read.where(F.size("found") > 0).join(drawn, F.col("list") == F.col("of_list"))
    # the text between the matches, then for each match its tokens with the kept text before each
    between = F.split(text, PII, -1)
    firsts = F.transform("found", lambda m: F.size(_tokens(m)))
    starts = F.aggregate(firsts, F.array(F.lit(0)), lambda s, n: F.concat(s, F.array(F.element_at(s, -1) + n)))
    replaced = F.transform("tokens", lambda t, i: F.concat(t["prefix"], F.get(F.col("new"), i)["surrogate"]))
    again = F.when(F.col("name").isNotNull(), F.flatten(F.transform(between, lambda piece: F.regexp_extract_all(piece, F.col("name"), F.lit(0)))))
    untitled = F.transform(again, lambda word: F.struct(F.lit("").alias("prefix"), F.col("named")[word]["kind"].alias("kind"), word.alias("value")))
    pieces = F.transform(between, lambda piece, i: F.concat(
        _renamed(piece), F.when(i < F.size("found"), F.array_join(F.slice(replaced, F.get(starts, i) + 1,
                                                                  F.get(firsts, i)), "")).otherwise("")))
    done = none.withColumn("new_text", text).select(*plain.columns, "tokens", "new_text").unionByName(
        some.withColumn("new_text", F.array_join(pieces, ""))
        .withColumn("tokens", F.concat("tokens", F.coalesce(untitled, F.array().cast(TOKENS))))
        .select(*plain.columns, "tokens", "new_text"))
    kinds = [_count(kind).alias(f"n_{kind}") for kind in KINDS]
    return done.select(*[(F.col("new_text") if c == text_col else F.col(f"c{i}")).alias(c) for i, c in enumerate(names)], *kinds)


def _count(kind: str) -> Column:
    return F.size(F.filter("tokens", lambda t: t["kind"] == kind)).cast("long")
