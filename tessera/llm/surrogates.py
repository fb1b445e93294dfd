"""Personal data replaced by surrogates of the same kind and form (operator 4); DataFrame operations only.

Detected entities become atoms: an address, a number, a secret, or the parts of a person's name. Every
distinct atom of the corpus gets one surrogate, drawn from a keyed hash in the atom's own form: digits
stay digits, letters letters of their script, given names keep their gender, card numbers their check
digit. The draw is repeated for atoms whose surrogate another atom has, or that is itself an atom of
the corpus, until all differ; after a few draws the form grows. So equal entities stay equal everywhere, different ones stay different,
and a mention is written in its own case and punctuation.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import scratch_path

#: Draws in an atom's own form; each later one has one more character or syllable, so every form suffices.
DRAWS = 6

# Titles and given names by gender.
FEMALE_TITLES = "Mrs Ms Miss Frau Madame Mme Señora Sra Signora Госпожа Κυρία".split()
MALE_TITLES = "Mr Herr Monsieur Señor Sr Signor Господин Κύριος".split()
OTHER_TITLES = "Dr Prof Mx".split()
FEMALE_NAMES = (
    "Mary Emily Jessica Jennifer Elizabeth Katherine Michelle Julia Sophie Charlotte Monika Petra Brigitte Heike "
    "Anna Maria Sarah Laura Lisa Linda Barbara Susan Nancy Karen Helen Sandra Carol Ruth Sharon Laura Emma Olivia Sophia Isabella "
    "Hannah Rachel Rebecca Amanda Nicole Megan Amy Angela Christine Martha Alice Jane Anne Margaret Patricia Deborah Stephanie Victoria "
    "Ursula Sabine Claudia Andrea Stefanie Katharina Ingrid Gisela Renate Birgit Silke Anja Lena Johanna "
    "Marie Camille Nathalie Isabelle Sylvie Céline Élodie Aurélie Mathilde Amélie Carmen Lucía Sofía Elena Ana Isabel Pilar Marta Paula "
    "Giulia Francesca Chiara Анна Елена Ирина Светлана Анастасия Людмила Μαρία Ελένη Άννα Σοφία "
    "Juliette Chloé Françoise Guadalupe Jimena Мария Ольга Наталья Татьяна Екатерина Κατερίνα Γεωργία"
).split()
MALE_NAMES = (
    "James Michael William Joseph Jack Benjamin Matthew Patrick Jürgen Wolfgang Klaus Friedrich Jacques Philippe "
    "John David Peter Paul Robert Richard Charles Thomas Christopher Daniel Anthony Donald Steven Andrew Kenneth George Joshua Kevin "
    "Brian Edward Ronald Timothy Jason Jeffrey Ryan Jacob Nicholas Eric Jonathan Stephen Larry Justin Scott Brandon Samuel Gregory "
    "Alexander Simon Oliver Henry Arthur Lucas Noah Liam Ethan Adam Nathan Hans Jürgen Stefan Andreas Martin Markus Sebastian Tobias Florian "
    "Johannes Matthias Uwe Heinz Dieter Günter Karl Pierre Jean Michel Nicolas Julien Antoine François Laurent Olivier Luc Carlos José "
    "Juan Luis Miguel Antonio Manuel Pedro Pablo Diego Fernando Alejandro Marco Giovanni Luca Matteo "
    "Александр Сергей Андрей Николай Павел Γιάννης Νίκος Δημήτρης "
    "Guillaume Joaquín Jorge Javier Иван Дмитрий Михаил Владимир Алексей Κώστας Γιώργος"
).split()

#: Syllables and endings that names are made of, by script.
SYLLABLES = {
    "latin": "ba ke lo mi nu pa ro su ta ve wi do ga hu je ko".split(),
    "cyrillic": "ба ке ло ми ну па ро су та ве во до га ху же ко".split(),
    "greek": "βα κε λο μι νυ πα ρο συ τα φε χι δο γα θυ ζε κο".split(),
}
ENDINGS = {
    ("latin", "f"): ["lia", "na", "ra", "ssa"], ("latin", "m"): ["lan", "mon", "ric", "ten"], ("latin", "s"): ["ner", "sted", "vick", "man"],
    ("cyrillic", "f"): ["лия", "на", "ра", "са"], ("cyrillic", "m"): ["лан", "мон", "рик", "тен"], ("cyrillic", "s"): ["нер", "стед", "вик", "ман"],
    ("greek", "f"): ["λια", "να", "ρα", "σα"], ("greek", "m"): ["λας", "μος", "ρης", "τος"], ("greek", "s"): ["νης", "δης", "ρου", "κας"],
}

NAME = r"\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)?"
TITLE = "(?:" + "|".join([*FEMALE_TITLES, *MALE_TITLES, *OTHER_TITLES]) + r")\b\.?"
#: By their first letter, so a word is held against few names.
GIVEN = "(?:" + "|".join(
    f"{letter}(?:" + "|".join(sorted({n[1:] for n in [*FEMALE_NAMES, *MALE_NAMES] if n[0] == letter})) + ")"
    for letter in sorted({n[0] for n in [*FEMALE_NAMES, *MALE_NAMES]})
) + ")"
PERSON = rf"(?=\p{{Lu}})(?<![\p{{L}}\p{{N}}])(?:{TITLE} {NAME}(?: {NAME})?|{GIVEN} {NAME})(?![\p{{L}}\p{{N}}])"
#: Kinds and what they look like, in the order in which they are tried at a place of the text. Each
#: begins with what rules most places out.
FORMS = {
    "email": r"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "secret": r"(?<=[=: \"'])(?<=[=:][ ]{0,3}[\"']?)(?<=(?i:password|passwd|pwd|secret|token|api[_-]?key)[\"']?[ ]{0,3}[=:][ ]{0,3}[\"']?)(?=[+/_.-]*[A-Za-z0-9])[A-Za-z0-9+/_.-]{6,}"
    r"|(?<![A-Za-z0-9])(?i:AKIA[A-Z0-9]{16}|ghp_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9-]{16,})(?![A-Za-z0-9])"
    r"|(?<![A-Za-z0-9])(?=[A-Fa-f]*[0-9])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])"
    r"|(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f]{0,4}:)(?=[A-Fa-f:]*[0-9])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    r"|(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?)(?![0-9A-Za-z:])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,3}"
    r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|(?:1[ .-])?[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}"
    r"|\(?0[1-9][0-9]{1,3}\)?[ /-][0-9]{3,4}(?:[ -]?[0-9]{2,4}){1,2}|0[1-9](?:[ .][0-9]{2}){4})(?![0-9])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){3}|[0-9]{4}(?:-[0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z])",
    "person": PERSON,
}
ANY = "|".join(f"(?:{form})" for form in FORMS.values())
#: Every entity holds a digit, an at sign, or follows a secret's name, or is a person.
PERHAPS = r"[0-9@]|[=:]"


def mentions(text: Column) -> Column:
    """All mentions in a text, in order."""
    return F.regexp_extract_all(text, F.lit(ANY), F.lit(0))


def kind_of(mention: Column) -> Column:
    """The kind of a mention; what only its surroundings mark is a secret."""
    kind = F.lit("secret")
    for name in ("person", "card", "phone", "ssn", "ip", "iban", "email"):
        kind = F.when(mention.rlike(f"^(?:{FORMS[name]})$"), name).otherwise(kind)
    return kind


def script_of(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def atoms_of(mention: Column) -> Column:
    """The atoms of a mention: ``kind`` (names with gender and script) and ``value``, its form without case and marks; a secret
    keeps its case, as secrets that differ in it are different ones."""
    kind = kind_of(mention)
    title = F.regexp_extract(mention, f"^({TITLE}) ", 1)
    words = F.split(F.regexp_replace(mention, f"^{TITLE} ", ""), " ")
    bare = F.regexp_replace(title, r"\.", "")
    first = words[0]
    female = bare.isin(FEMALE_TITLES) | (~bare.isin(MALE_TITLES) & first.isin(FEMALE_NAMES))
    given = F.concat(F.lit("given-"), F.when(female, "f").otherwise("m"), F.lit("-"), script_of(first))

    def atom(kind: Column, value: Column) -> Column:
        return F.struct(kind.alias("kind"), value.alias("value"))

    surname = atom(F.concat(F.lit("surname-"), script_of(F.element_at(words, -1))), F.lower(F.element_at(words, -1)))
    person = F.when(F.size(words) > 1, F.array(atom(given, F.lower(first)), surname)).otherwise(F.array(surname))
    plain = (
        F.when(kind == "email", F.lower(mention))
        .when(kind.isin("phone", "card", "ssn"), F.regexp_replace(mention, "[^0-9]", ""))
        .when(kind == "iban", F.replace(mention, F.lit(" "), F.lit("")))
        .when(kind == "secret", mention)
        .otherwise(F.lower(mention))
    )
    return F.when(kind == "person", person).otherwise(F.array(atom(kind, plain)))


def drawn(key: str, kind: Column, value: Column, draw: int) -> Column:
    """The surrogate of an atom at a draw; from ``DRAWS`` on it is longer than the atom's form."""
    seeds = [F.sha2(F.concat_ws("\x1f", F.lit(key), kind, value, F.lit(str(draw)), F.lit(str(i))), 512) for i in range(4)]
    noise = F.concat(*seeds)
    more = max(0, draw - DRAWS + 1)
    own, value = value, F.concat(value, F.lit("0" * more))

    def number(at: Column) -> Column:
        return F.conv(F.substring(noise, (at * 4) % 512 + 1, F.lit(4)), 16, 10).cast("int")

    def one_of(choices: str, at: Column) -> Column:
        return F.substring(F.lit(choices), number(at) % len(choices) + 1, F.lit(1))

    hexadecimal = own.rlike("^[0-9a-f]+$") & (kind == "secret")

    def filled(part: Column, shift: int = 0) -> Column:
        def char(c: Column, i: Column) -> Column:
            at = i + shift
            return (
                F.when(hexadecimal, one_of("0123456789abcdef", at))
                .when(c.rlike("[0-9]"), one_of("0123456789", at))
                .when(c.rlike("[a-z]"), one_of("abcdefghijklmnopqrstuvwxyz", at))
                .when(c.rlike("[A-Z]"), one_of("ABCDEFGHIJKLMNOPQRSTUVWXYZ", at))
                .otherwise(c)
            )

        return F.array_join(F.transform(F.split(part, ""), char), "")

    def name(script: str, ending: str, syllables: int) -> Column:
        parts = [F.element_at(F.array(*map(F.lit, SYLLABLES[script])), number(F.lit(i)) % len(SYLLABLES[script]) + 1) for i in range(syllables + more)]
        last = ENDINGS[script, ending]
        return F.concat(*parts, F.element_at(F.array(*map(F.lit, last)), number(F.lit(127)) % len(last) + 1))

    def kept(n: int) -> Column:
        return F.concat(F.substring(value, 1, n), F.substring(filled(value), F.lit(n + 1), F.length(value)))

    local, domain = F.concat(F.substring_index(own, "@", 1), F.lit("0" * more)), F.substring_index(own, "@", -1)
    top = F.substring_index(domain, ".", -1)
    host = F.substring(domain, F.lit(1), F.length(domain) - F.length(top) - 1)
    octets = [(number(F.lit(i)) % 254 + 1).cast("string") for i in range(3)]
    # IPv4 has no longer form: its later draws are private IPv6 addresses.
    version6 = F.concat(F.lit("fd"), *(F.concat(F.lit(":" if i else ""), F.substring(noise, 4 * i + 1, 4 if i else 2)) for i in range(8)))
    version4 = version6 if more else F.concat_ws(".", F.lit("10"), *octets)
    digits = kept(1)
    fixed = F.concat(F.substring(digits, F.lit(1), F.length(digits) - 1), ((10 - luhn(F.concat(F.substring(digits, F.lit(1), F.length(digits) - 1), F.lit("0")))) % 10).cast("string"))
    found = F.when(kind == "email", F.concat(filled(local), F.lit("@"), filled(host, 64), F.lit("."), top))
    found = found.when(kind == "ip", F.when(own.contains(":"), version6).otherwise(version4))
    found = found.when(kind == "card", F.when(luhn(own) == 0, fixed).otherwise(digits))
    found = found.when(kind == "phone", kept(1)).when(kind == "ssn", F.concat(F.lit("9"), F.substring(filled(value), F.lit(2), F.length(value))))
    found = found.when(kind == "iban", F.concat(F.substring(value, 1, 2), F.substring(filled(value), F.lit(3), F.length(value))))
    for script in SYLLABLES:
        for gender in ("f", "m"):
            found = found.when(kind == f"given-{gender}-{script}", name(script, gender, 3))
        found = found.when(kind == f"surname-{script}", name(script, "s", 4))
    marked = F.regexp_extract(value, "^(?i)(akia|ghp_|sk-)", 1)
    return found.otherwise(F.concat(marked, F.substring(filled(value), F.length(marked) + 1, F.length(value))))


def luhn(digits: Column) -> Column:
    """The check sum of a number, modulo 10; 0 if it is valid."""

    def weighed(d: Column, i: Column) -> Column:
        n = d.cast("int")
        return F.when(i % 2 == 0, n).otherwise(F.when(n > 4, 2 * n - 9).otherwise(2 * n))

    return F.aggregate(F.transform(F.reverse(F.split(digits, "")), weighed), F.lit(0), lambda a, b: a + b) % 10


def registry(atoms: DataFrame, key: str) -> DataFrame:
    """``kind, value, surrogate`` of every atom: distinct within a kind, and none an atom itself.

    This ends, as each draw after the first ones has at least ten times the forms of the one before.
    """
    spark = atoms.sparkSession

    def written(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "surrogates")
        df.write.parquet(path)
        return spark.read.parquet(path)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    todo = atoms = written(atoms.distinct())
    taken = None
    for draw in count():
        # The draws are heavy for the rows' size, so these are dealt out whatever it is.
        tried = todo.repartition(parts).withColumn("surrogate", drawn(key, F.col("kind"), F.col("value"), draw))
        own = atoms.select("kind", F.col("value").alias("surrogate"))
        tried = tried.join(own.withColumn("real", F.lit(True)), ["kind", "surrogate"], "left")
        if taken is not None:
            tried = tried.join(taken.select("kind", "surrogate").withColumn("used", F.lit(True)), ["kind", "surrogate"], "left")
        else:
            tried = tried.withColumn("used", F.lit(None).cast("boolean"))
        first = F.row_number().over(Window.partitionBy("kind", "surrogate").orderBy("value"))
        tried = written(tried.withColumn("good", (first == 1) & F.col("real").isNull() & F.col("used").isNull()))
        good = tried.where("good").select("kind", "value", "surrogate")
        taken = good if taken is None else taken.unionByName(good)
        todo = tried.where("not good").select("kind", "value")
        if todo.isEmpty():
            return taken


def written_as(mention: Column, parts: Column) -> Column:
    """The surrogates of a mention's atoms in its case and punctuation."""
    kind = kind_of(mention)
    one = parts[0]
    shouted = (mention == F.upper(mention)) & mention.rlike(r"\p{Lu}")

    def slotted(pattern: str) -> Column:
        """The surrogate's characters in the places of the mention's that fit the pattern, the rest behind them."""
        chars = F.split(mention, "")
        slots = F.length(F.regexp_replace(mention, f"[^{pattern[1:]}", ""))
        filled = F.array_join(
            F.transform(
                chars,
                lambda c, i: F.when(
                    c.rlike(pattern),
                    F.substring(one, F.length(F.regexp_replace(F.substring(mention, F.lit(1), i), f"[^{pattern[1:]}", "")) + 1, F.lit(1)),
                ).otherwise(c),
            ),
            "",
        )
        return F.concat(filled, F.substring(one, slots + 1, F.length(one)))

    title = F.regexp_extract(mention, f"^({TITLE} )", 1)
    person = F.concat(title, F.array_join(F.transform(parts, lambda p: F.initcap(p)), " "))
    return (
        F.when(kind == "person", person)
        .when(kind.isin("phone", "card", "ssn"), slotted("[0-9]"))
        .when(kind == "iban", slotted("[A-Z0-9]"))
        .when(kind == "secret", one)
        .otherwise(F.when(shouted, F.upper(one)).otherwise(one))
    )


def replaced(docs: DataFrame, key: str, doc: str = "doc_id", text: str = "text", count: str | None = None) -> DataFrame:
    """The rows with every mention in ``text`` replaced; all other columns stay as they are.

    ``count`` names an added column with the number of mentions. Null texts stay null. Rows with null
    or repeated ids are replaced like any other, as a surrogate hangs on the entity alone. Case inside a
    word is not kept, only whole capitals. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    words = F.col("row").getField(text)
    perhaps = F.coalesce(words.rlike(PERHAPS) | words.rlike(PERSON), F.lit(False))

    def rebuilt(df: DataFrame, new: Column, n: Column) -> DataFrame:
        columns = [new.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns]
        return df.select(*columns, *([n.cast("long").alias(count)] if count else []))

    path = scratch_path(spark, "mentions")
    pairs = held.where(perhaps).select(F.col("row").getField(doc).alias("id"), F.explode(F.array_distinct(mentions(words))).alias("mention"))
    pairs.write.parquet(path)
    pairs = spark.read.parquet(path)
    dealt = pairs.select("mention").distinct().repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "mention")
    distinct = dealt.select("mention", F.posexplode(atoms_of(F.col("mention"))).alias("at", "atom"))
    distinct = distinct.select("mention", "at", "atom.kind", "atom.value")
    names = registry(distinct.select("kind", "value"), key)
    parts = distinct.join(names, ["kind", "value"]).groupBy("mention").agg(F.array_sort(F.collect_list(F.struct("at", "surrogate"))).alias("parts"))
    new = parts.select("mention", written_as(F.col("mention"), F.transform("parts", lambda p: p["surrogate"])).alias("new"))
    per_doc = pairs.join(new, "mention").groupBy("id").agg(F.map_from_entries(F.collect_set(F.struct("mention", "new"))).alias("news"))
    joined = held.where(perhaps).join(per_doc, F.col("row").getField(doc).eqNullSafe(F.col("id")), "left")
    found, between = mentions(words), F.split(words, ANY, -1)
    news = F.transform(found, lambda m: F.col("news")[m])
    woven = F.array_join(F.zip_with(between, news, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    changed = rebuilt(joined, F.when(F.col("news").isNull(), words).otherwise(woven), F.when(F.col("news").isNull(), 0).otherwise(F.size(found)))
    return changed.unionByName(rebuilt(held.where(~perhaps), words, F.lit(0)))
