"""Replacing personal data and secrets by keyed surrogates of the same kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from viewpulse.llm.common import fresh, hash128, let, same, stored, unstored

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_NAME = r"\p{Lu}[\p{L}'’-]+(?: \p{Lu}[\p{L}'’-]+)?"
#: Titles that tell the gender of the name behind them.
TITLES = {
    "m": ["Mr.", "Mr", "Mister", "Herr", "Hr.", "Monsieur", "Señor", "Sr.", "Господин", "Κύριος"],
    "f": ["Mrs.", "Mrs", "Ms.", "Ms", "Miss", "Frau", "Fr.", "Madame", "Mme.", "Mme", "Mademoiselle", "Mlle.", "Señora",
          "Señorita", "Sra.", "Srta.", "Госпожа", "Κυρία"],
    "n": ["Dr.", "Prof."],
}
_TITLE = "(?:" + "|".join(t.replace(".", r"\.") for own in TITLES.values() for t in own) + ")"
#: What is looked for, in this order; a secret stands behind a word, in any case, that announces it.
PATTERNS = {
    "secret": r"(?<=(?i:password|passwd|secret|token|api_key|apikey) ?[=:] ?[\"']?)[^\s\"'=:][^\s\"']{5,}",
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "access_key": r"\bAKIA[A-Z0-9]{16}\b",
    "phone": r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,5}(?:[ .-]?[0-9]{2,5}){1,4}\b|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}\b",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    "card": r"\b[0-9]{4}(?<gap>[ -]?)[0-9]{4}\k<gap>[0-9]{4}\k<gap>[0-9]{4}\b",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    "name": rf"\b{_TITLE} {_NAME}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: A text without any of these has nothing that the patterns match.
HINT = rf"[0-9@]|{_TITLE} \p{{Lu}}|AKIA|(?i:password|passwd|secret|token|api_?key) ?[=:]"
DIGITS = ("phone", "card", "ssn")
#: Country codes of telephone numbers (fixed by their plan): one, two or else three digits.
COUNTRY = r"^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
#: Attempts after which surrogates grow, so that there is always a free one, and after which something must be wrong.
GROW, ATTEMPTS = 7, 64
#: First names by script and gender, and the syllables that surnames are made of.
FIRST_NAMES = {
    "latin": {"m": ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Leon", "Martin", "Oscar", "Paul", "Robin",
                    "Simon", "Tobias", "Victor"],
              "f": ["Alice", "Bianca", "Clara", "Diana", "Emma", "Flora", "Hanna", "Irene", "Laura", "Maria", "Nina", "Olivia",
                    "Paula", "Sofia", "Teresa", "Vera"]},
    "cyrillic": {"m": ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Лев"],
                 "f": ["Анна", "Вера", "Дарья", "Елена", "Ирина", "Лидия", "Мария", "Ольга"]},
    "greek": {"m": ["Αλέξης", "Γιώργος", "Δημήτρης", "Κώστας"], "f": ["Άννα", "Ελένη", "Μαρία", "Σοφία"]},
}
SYLLABLES = {
    "latin": ["bar", "den", "fal", "gor", "hal", "ker", "lin", "mar", "nor", "pol", "ran", "sel", "tor", "vin", "wes", "zan"],
    "cyrillic": ["бар", "вел", "гор", "дан", "кор", "лин", "мар", "нов", "пол", "рад", "сел", "тор"],
    "greek": ["αλ", "βαρ", "γερ", "δαν", "καλ", "λυκ", "μαν", "νικ", "παπ", "σαρ", "τελ", "φιλ"],
}


def number(seed: Column, i: Column | int) -> Column:
    """The i-th 31-bit number of a seed."""
    return F.shiftright(F.conv(F.substring(F.sha2(F.concat_ws(":", seed, F.lit(i).cast("string")), 256), 1, 8), 16, 10)
                        .cast("long"), 1)


def pick(items: list[str], n: Column) -> Column:
    return F.get(F.array(*map(F.lit, items)), (n % len(items)).cast("int"))


def redrawn(text: Column, seed: Column, keep: Column | int = 0) -> Column:
    """Every letter and digit drawn anew within its class, case and script; the first ``keep`` characters stay.

    Text in hexadecimal digits stays so.
    """
    hexadecimal = text.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")

    def one(c: Column, i: Column) -> Column:
        n = number(seed, i)
        drawn = lambda first, size: F.char((F.lit(first) + n % size)) if first < 256 else pick(
            [chr(first + k) for k in range(size)], n)
        return (F.when(i < keep, c).when(c.rlike("[0-9]"), drawn(48, 10))
                .when(c.rlike("[a-z]"), F.when(hexadecimal, drawn(97, 6)).otherwise(drawn(97, 26)))
                .when(c.rlike("[A-Z]"), F.when(hexadecimal, drawn(65, 6)).otherwise(drawn(65, 26))).when(c.rlike(r"[а-яё]"), drawn(0x430, 32))
                .when(c.rlike(r"[А-ЯЁ]"), drawn(0x410, 32)).when(c.rlike(r"(?=\p{IsGreek})\p{Ll}"), drawn(0x3B1, 17))
                .when(c.rlike(r"(?=\p{IsGreek})\p{Lu}"), drawn(0x391, 17)).when(c.rlike(r"\p{Ll}"), drawn(97, 26))
                .when(c.rlike(r"\p{Lu}"), drawn(65, 26)).otherwise(c))
    return F.array_join(F.transform(F.split(text, ""), one), "")


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a number without its check digit: every second digit from the right counts twice."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.aggregate(values, F.lit(0), lambda s, x: s + x)


def luhn_digit(digits: Column) -> Column:
    return ((10 - luhn_sum(digits) % 10) % 10).cast("string")


def with_kind(matches: DataFrame) -> DataFrame:
    """Add ``kind``, ``canonical`` (the entity, however it is written), ``gender`` of a name."""
    m = F.col("match")
    kind = F.lit("secret")
    for name in reversed([k for k in PATTERNS if k != "secret"]):
        kind = F.when(m.rlike(f"^(?:{PATTERNS[name]})$"), F.lit(name)).otherwise(kind)
    # the context of a secret is gone: what is announced as one and looks like another kind counts as that kind
    matches = matches.withColumn("kind", kind)
    digits = F.regexp_replace(m, "[^0-9]", "")
    number_only = (F.col("kind") == "card") & (luhn_digit(F.substring(digits, 1, 15)) != F.substring(digits, -1, 1))
    matches = matches.withColumn("kind", F.when(~number_only, F.col("kind")))  # no kind: any number of 16 digits, left alone
    k = F.col("kind")
    bare = F.regexp_replace(m, f"^{_TITLE} ", "")
    gender = F.lit("n")
    for g in ("m", "f"):
        own = "|".join(t.replace(".", r"\.") for t in TITLES[g])
        gender = F.when(m.rlike(f"^(?:{own}) "), F.lit(g)).otherwise(gender)
    return matches.withColumn("canonical", F.when(
        k == "phone", F.regexp_replace(m, "[^+0-9]", "")).when(k.isin(*DIGITS), digits).when(
        k == "email", F.lower(m)).when(k == "name", F.lower(bare)).otherwise(m)).withColumn(
        "gender", F.when(k == "name", gender).otherwise("n"))


def surname(syllables: list[str], seed: Column) -> Column:
    """A name of three syllables and one more for every further attempt."""
    own = F.transform(F.sequence(F.lit(1), F.col("attempt") + 3), lambda i: pick(syllables, number(seed, i)))
    return F.initcap(F.array_join(own, ""))


def surrogate(key: str) -> Column:
    """The replacement of (``kind``, ``canonical``, ``gender``) at a given ``attempt``, in canonical form."""
    c, kind = F.col("canonical"), F.col("kind")
    seed = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, c, F.col("attempt").cast("string"), F.lit(key)), 256)

    def drawn(s: Column) -> Column:
        growth = F.greatest(F.col("attempt") - GROW, F.lit(0))
        longer = redrawn(F.repeat(F.lit("0"), growth), F.concat(s, F.lit("m")))
        head = F.substring(redrawn(c, s, 1), 1, 15)
        octets = F.array_join(F.transform(F.sequence(F.lit(0), growth + 3), lambda i: (number(s, i) % 254 + 1).cast("string")), ".")
        # the country code stays, the number behind it starts with 2 to 9
        code = F.regexp_extract(c, COUNTRY, 0)
        phone = F.concat(code, (number(s, "area") % 8 + 2).cast("string"), F.substring(redrawn(c, s), F.length(code) + 2, F.lit(99)), longer)
        domain = redrawn(F.regexp_replace(F.substring_index(c, "@", -1), r"\.[^.]+$", ""), F.concat(s, F.lit("d")))
        more = redrawn(F.repeat(F.lit("a"), growth), F.concat(s, F.lit("m")))
        email = F.concat(redrawn(F.substring_index(c, "@", 1), s), more, F.lit("@"), domain, F.lit(".example"))
        words = F.split(c, " ")
        script = F.when(c.rlike(r"\p{IsCyrillic}"), "cyrillic").when(c.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
        first, last = F.lit(None).cast("string"), F.lit(None).cast("string")
        for own, by_gender in FIRST_NAMES.items():
            named = F.when(F.col("gender") == "m", pick(by_gender["m"], number(s, 0))).when(
                F.col("gender") == "f", pick(by_gender["f"], number(s, 0))).otherwise(
                pick(by_gender["m"] + by_gender["f"], number(s, 0)))
            first = F.when(script == own, named).otherwise(first)
            # a further attempt has a further syllable: there is always a free name
            last = F.when(script == own, surname(SYLLABLES[own], s)).otherwise(last)
        name = F.when(F.size(words) > 1, F.concat_ws(" ", first, last)).otherwise(last)
        grown = F.concat(head, longer)
        return (F.when(kind == "card", F.concat(grown, luhn_digit(grown))).when(kind == "ssn", F.concat(redrawn(c, s), longer))
                .when(kind == "ip", octets).when(kind == "phone", phone).when(kind == "email", email)
                .when(kind == "access_key", F.concat(redrawn(c, s, 4), F.upper(more))).when(kind == "name", name)
                .otherwise(F.concat(redrawn(c, s), more)))
    return let(seed, drawn)


def dictionary(entities: DataFrame, key: str) -> DataFrame:
    """A surrogate for every (``kind``, ``canonical``) such that no two entities share one and none is an entity itself.

    Surrogates come from a keyed hash, the same in every document and run.  Where one is taken (the earlier attempt, then
    the smaller entity has it) or is the name of an entity found in the text, the next attempt is drawn, until none clash.
    A form may have no free surrogate (of 10,000 phone numbers of five digits that begin alike all may be real): from the
    :data:`GROW`-th attempt on surrogates of every kind grow by a character each time.  More than :data:`ATTEMPTS` rounds
    raise an error.
    """
    rank = F.when(F.col("gender") == "n", 0).otherwise(1)
    table = stored(entities.groupBy("kind", "canonical").agg(
        F.max(F.struct(rank.alias("r"), F.col("gender").alias("gender"))).alias("g")).select(
        "kind", "canonical", F.col("g.gender").alias("gender"), F.lit(0).alias("attempt")), "entities")
    for _ in range(ATTEMPTS):
        drawn = stored(table.withColumn("surrogate", surrogate(key)), "surrogates")
        order = Window.partitionBy("kind", "_plain").orderBy("attempt", "canonical")
        plain = F.when(F.col("kind") == "name", F.lower("surrogate")).otherwise(F.col("surrogate"))
        ranked = drawn.withColumn("_plain", plain).withColumn("_place", F.row_number().over(order))
        real = drawn.select(F.col("kind").alias("_kind"), F.col("canonical").alias("_plain_of"))
        judged = ranked.join(real, (ranked["kind"] == real["_kind"]) & (ranked["_plain"] == real["_plain_of"]), "left")
        taken = (F.col("_place") > 1) | F.col("_plain_of").isNotNull()
        judged = stored(judged.select("kind", "canonical", "gender", "surrogate",
                                      (F.col("attempt") + taken.cast("int")).alias("attempt"), taken.alias("taken")), "judged")
        unstored(drawn)
        if not judged.where("taken").limit(1).count():
            return judged.select("kind", "canonical", "surrogate")
        table = judged.select("kind", "canonical", "gender", "attempt")
    raise RuntimeError(f"surrogates still clash after {ATTEMPTS} attempts")


def written(match: Column, kind: Column, name: Column) -> Column:
    """A surrogate in the way the match is written: separators, title and capitals as there; digits it has more come last."""
    name = F.when(kind.isin(*DIGITS), F.regexp_replace(name, "[^0-9]", "")).otherwise(name)
    filled = F.aggregate(F.split(match, ""), F.struct(F.lit("").alias("out"), F.lit(0).alias("k")), lambda s, c: F.when(
        c.rlike("[0-9]"), F.struct(F.concat(s["out"], F.substring(name, s["k"] + 1, F.lit(1))).alias("out"),
                                   (s["k"] + 1).alias("k"))).otherwise(
        F.struct(F.concat(s["out"], c).alias("out"), s["k"].alias("k"))), lambda s: F.concat(
            s["out"], F.substring(name, s["k"] + 1, F.length(name))))
    title = F.regexp_extract(match, f"^({_TITLE} )", 1)
    shouted = match == F.upper(match)
    return (F.when(kind.isin(*DIGITS), filled).when(kind == "name", F.concat(title, name))
            .when((kind == "email") & shouted, F.upper(name)).otherwise(name))


def replace_pii(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Replace personal data and secrets by surrogates of their kind.

    Found are the kinds of :data:`PATTERNS`; 16 digits are a card number only where their check digit fits.  A surrogate keeps
    length (but see :func:`dictionary`), separators, character classes and script, the check digit of cards, the country code of
    phone numbers, the gender of titled names; mail addresses end in the reserved ``.example``.  The same entity
    has the same surrogate in all documents, different ones differ (:func:`dictionary`).  A full name that stood behind a
    title is also replaced where it stands alone in the same document.

    Returns the columns of ``docs`` with the new text, ``n_found`` and ``kinds`` (sorted, joined by commas; empty if none);
    columns of ``docs`` with these names are replaced.  A null text stays null; texts without matches stay as they are.
    Matches are joined to the dictionary as single rows, so an entity of many documents is never gathered; a document's own
    matches are.
    """
    docs = docs.drop("n_found", "kinds")
    key1, key2, id_, found, names, kinds = fresh(docs, "_t1", "_t2", "_of", "_found", "_names", "_kinds")
    t1, t2 = hash128(F.col(text_col))
    hinted = docs.where(F.col(text_col).rlike(HINT)).select(F.col(id_col).alias("id"), t1.alias("t1"), t2.alias("t2"), F.posexplode(
        F.regexp_extract_all(F.col(text_col), F.lit(ANY), F.lit(0))).alias("pos", "match"))
    matches = stored(with_kind(hinted), "matches")
    known = dictionary(matches.where("kind is not null").select("kind", "canonical", "gender"), key)
    bare = F.when(F.col("kind") == "name", F.regexp_replace("match", f"^{_TITLE} ", ""))
    plain = matches.where("kind is null").withColumn("surrogate", F.col("match"))  # keeps its place among the matches
    own = matches.join(known, ["kind", "canonical"]).unionByName(plain).groupBy(
        F.col("id").alias(id_), F.col("t1").alias(f"{key1}_of"), F.col("t2").alias(f"{key2}_of")).agg(
        F.sort_array(F.collect_set(F.struct("pos", F.coalesce(written(F.col("match"), F.col("kind"), F.col("surrogate")), "match").alias("new"),
                                            F.col("kind").isNotNull().alias("real")))).alias(found),
        F.collect_set(F.when(bare.contains(" "), F.struct(bare.alias("old"), F.col("surrogate").alias("new")))).alias(names),
        F.array_join(F.sort_array(F.collect_set("kind")), ",").alias(kinds))
    hashed = docs.withColumn(key1, t1).withColumn(key2, t2)
    met = hashed.join(own, same(hashed, own, (id_col, id_), (key1, f"{key1}_of"), (key2, f"{key2}_of")), "left")
    gaps = F.transform(F.split(F.col(text_col), ANY, -1), lambda gap: F.aggregate(
        F.col(names), gap, lambda g, n: F.replace(g, n["old"], n["new"])))
    new = let(gaps, lambda gap: F.concat(F.get(gap, F.lit(0)), F.array_join(F.transform(
        F.col(found), lambda r, i: F.concat(r["new"], F.get(gap, i + 1))), "")))
    text = F.when(F.col(found).isNull(), F.col(text_col)).otherwise(new)
    return met.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns],
                      F.when(F.col(found).isNull(), 0).otherwise(F.size(F.filter(found, lambda r: r["real"]))).cast("long").alias("n_found"),
                      F.coalesce(kinds, F.lit("")).alias("kinds"))
