"""Surrogates for personal data: keyed, type-consistent replacements.

Entities are found by ``PATTERNS``. Each mention is normalised (case and
punctuation left out), so all spellings of one entity are one entry of the
entity table and get one surrogate everywhere. A surrogate is drawn from a
keyed hash of the entity and keeps its type and format: digits stay digits,
letters stay letters of their script, separators, case, country codes and
top-level domains stay; a card number that passes the Luhn test gets one that
does; an IPv4 address stays one; names keep title, gender and script.

A person is found by a title (``Mrs. Anna Smith``). The parts of such a name
are then further mentions in the same text, alone or in a row, as written there
or in capitals (``Anna Smith``, ``Smith``), with the surrogate of the first titled
mention that has the part. A name that no title introduces in its text is not
found.

Collision checks: no two entities of a type share a surrogate, and no
surrogate is itself an entity of the corpus. Entities that fail draw again
with the next nonce, until none does; the least entity of a collision keeps
its draw.

All of it is DataFrame functions. Only texts with entities are moved: their
mentions meet the surrogates through ``join_hot`` (one address may stand in a
third of all texts) and come back as one list per text; all other rows pass
straight through.

Defined results: a null text stays null, an empty one empty; repeated rows are
replaced alike; an empty table gives no rows; all columns are carried, and
``n_replaced`` (or ``_n_replaced`` ... if taken) is added.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import fresh, join_hot, work_dir, written

#: Titles with the gender they tell (fixed values).
TITLES = {"Mr": "m", "Mister": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "господин": "m", "Господин": "m",
          "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Señora": "f", "Sra": "f",
          "госпожа": "f", "Госпожа": "f"}
#: Types in the order in which they are tried. None matches an empty string or uses a capturing group.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+",
    "secret": r"(?i:\b(?:token|secret|password|passwd|api[_-]?key)\b)\s*+[=:]\s*+[\"'][^\"'\s]{8,}+[\"']",
    "key": r"(?<![\p{L}\p{N}])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,255}|(?=[a-fA-F]*+[0-9])[0-9a-fA-F]{32,}+)(?![\p{L}\p{N}])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ip": r"(?<![\p{N}.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?!\.?[0-9])",
    "card": r"(?<![\p{L}\p{N}+.-])(?:[0-9]{4}[ -]?){3}[0-9]{4}(?![\p{L}\p{N}])",
    "phone": r"(?<![\p{L}\p{N}])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}(?![\p{L}\p{N}])"
             r"|(?<![\p{L}\p{N}])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![\p{N}])"
             r"|(?<![\p{L}\p{N}.-])[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![\p{N}])",
    "ssn": r"(?<![\p{L}\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}-])",
    "person": rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(TITLES)})\.? \p{{Lu}}\p{{L}}+(?:-\p{{Lu}}\p{{L}}+)?(?: \p{{Lu}}\p{{L}}+(?:-\p{{Lu}}\p{{L}}+)?)?",
}
ANY = "|".join(PATTERNS.values())
#: Every entity holds one of these; a text without them needs no look at ``ANY``.
HINT = r"[0-9@=]|:\s*+[\"']|AKIA|gh[pousr]_|" + "|".join(TITLES)
#: Syllables of made-up names by script, and their endings by gender (fixed values).
SYLLABLES = {
    "Latn": ["ba", "den", "for", "gar", "hol", "kin", "lan", "mer", "nor", "pel", "ros", "sten", "tor", "val", "wes", "lin"],
    "Cyrl": ["ба", "дан", "вор", "гар", "хол", "кин", "лан", "мер", "нор", "пел", "рос", "стен", "тор", "вал", "зим", "лин"],
}
ENDINGS = {("given", "Latn", "f"): "a", ("given", "Latn", "m"): "us", ("family", "Latn", "f"): "er", ("family", "Latn", "m"): "er",
           ("given", "Cyrl", "f"): "а", ("given", "Cyrl", "m"): "ий", ("family", "Cyrl", "f"): "ова", ("family", "Cyrl", "m"): "ов"}
HEX = "0123456789abcdef"
ROUNDS = 100


def _cases(pairs, default: Column) -> Column:
    return reduce(lambda rest, p: F.when(p[0], p[1]).otherwise(rest), reversed(list(pairs)), default)


def mention_type(mention: Column) -> Column:
    """The first type whose pattern is the whole mention. Patterns look
    around themselves, so a mention alone still fits its own."""
    return _cases([(F.rlike(mention, F.lit(f"^(?:{p})$")), F.lit(t)) for t, p in PATTERNS.items()], F.lit("person"))


def _normal(kind: Column, mention: Column) -> Column:
    """What all spellings of an entity share."""
    plain = F.lower(F.regexp_replace(mention, r"[^\p{L}\p{N}]", ""))
    value = F.regexp_extract(mention, r"[\"']([^\"'\s]+)[\"']$", 1)
    return _cases([(kind == "email", F.lower(mention)), (kind == "ip", mention), (kind == "secret", F.lower(value)),
                   (kind == "phone", F.concat(F.when(mention.startswith("+"), F.lit("+")).otherwise(""), plain))], plain)


def _titled(mention: Column) -> Column:
    return F.rlike(mention, F.lit(f"^(?:{PATTERNS['person']})$"))


def _names(mentions: Column) -> Column:
    """Parts of the titled names among a text's mentions."""
    parts = F.flatten(F.transform(F.filter(mentions, _titled), lambda m: _parts(m)))
    return F.array_distinct(F.filter(parts, lambda p: (p["type"] != "") & ~p["shown"].isin(*TITLES)))


def _with_names(names: Column) -> Column:
    """``ANY``, and the names of a text as whole words, longest first. Names
    are letters and hyphens only."""
    shown = F.transform(names, lambda p: p["shown"])
    words = F.array_distinct(F.concat(shown, F.transform(shown, F.upper)))
    words = F.reverse(F.array_sort(F.transform(words, lambda w: F.struct(F.length(w).alias("n"), w.alias("w")))))
    one = F.concat(F.lit("(?:"), F.array_join(F.transform(words, lambda x: x["w"]), "|"), F.lit(r")(?![\p{L}\p{N}])"))
    return F.concat(F.lit(ANY + r"|(?<![\p{L}\p{N}])"), one, F.lit("(?: "), one, F.lit(")*+"))


def _parts(mention: Column, names: Column | None = None) -> Column:
    """Parts of a mention, each (type, norm, shown); type "" is kept as it is.
    A name without a title has the types of ``names``."""
    kind = mention_type(mention)
    words = F.split(mention, " ")
    title = F.regexp_replace(F.get(words, F.lit(0)), r"\.$", "")
    gender = _cases([(title == t, F.lit(g)) for t, g in TITLES.items()], F.lit("m"))
    part = lambda t, n, s: F.struct(t.alias("type"), n.alias("norm"), s.alias("shown"))

    def name(w: Column, i: Column) -> Column:
        script = F.when(F.rlike(w, F.lit(r"\p{IsCyrillic}")), F.lit("Cyrl")).otherwise("Latn")
        role = F.when(i == F.size(words) - 1, F.lit("family")).otherwise("given")
        titled = F.when(i == 0, F.lit("")).otherwise(F.concat_ws(" ", role, script, gender))
        if names is None:
            return part(titled, F.lower(w), w)
        known = F.get(F.filter(names, lambda p: p["norm"] == F.lower(w)), F.lit(0))["type"]
        return part(F.when(_titled(mention), titled).otherwise(known), F.lower(w), w)
    return F.when(kind == "person", F.transform(words, name)).otherwise(F.array(part(kind, _normal(kind, mention), mention)))


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string whose last digit is the check digit."""
    def step(acc: Column, d: Column) -> Column:
        n = d.cast("int") * (1 + acc["odd"])
        return F.struct((acc["sum"] + n - F.when(n > 9, 9).otherwise(0)).alias("sum"), (1 - acc["odd"]).alias("odd"))
    zero = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("odd"))
    return F.aggregate(F.reverse(F.split(digits, "")), zero, step)["sum"]


def surrogate(kind: Column, norm: Column, nonce: Column, key: str) -> Column:
    """The nonce-th draw for an entity, in normal form."""
    def drawn(*what: Column) -> Column:
        return F.sha2(F.concat_ws("\x1f", F.lit(key), *what), 512)

    h = drawn(kind, nonce.cast("string"), norm)
    at = F.instr(norm, "@")
    tld = F.length(norm) - F.length(F.substring_index(norm, ".", -1))
    domain = drawn(F.lit("domain"), F.substring_index(norm, "@", -1))

    def letter(c: Column, i: Column, once: Column) -> Column:
        x = F.substring(F.when((kind == "email") & (i + 1 > at), domain).otherwise(once), F.pmod(i, F.lit(128)) + 1, F.lit(1))
        same = ((kind == "email") & ((c == "@") | (i >= tld))) | ((kind == "card") & (i == 0)) | ((kind == "iban") & (i < 2)) \
            | ((kind == "phone") & (i == 1) & norm.startswith("+"))
        hexed = kind.isin("secret", "key") & F.rlike(c, F.lit("[a-f]"))
        return _cases([(same, c), (F.rlike(c, F.lit("[0-9]")), F.translate(x, "abcdef", "739150")),
                       (hexed, F.translate(x, HEX, "abcdefabcdefabcd")),
                       (F.rlike(c, F.lit(r"\p{IsCyrillic}")), F.translate(x, HEX, "абвгдежзиклмнопр")),
                       (F.rlike(c, F.lit(r"\p{L}")), F.translate(x, HEX, "abdeghiklmnoprst"))], c)

    # the hash as a lambda variable: made once, not for each letter
    plain = F.get(F.transform(F.array(h), lambda once: F.array_join(
        F.transform(F.split(norm, ""), lambda c, i: letter(c, i, once)), "")), F.lit(0))
    body = F.substring(plain, F.lit(1), F.length(plain) - 1)
    check = F.pmod(10 - _luhn_sum(F.concat(body, F.lit("0"))) % 10, F.lit(10)).cast("string")
    card = F.when(_luhn_sum(norm) % 10 == 0, F.concat(body, check)).otherwise(plain)
    octet = lambda k: (F.pmod(F.conv(F.substring(h, 1 + 8 * k, 8), 16, 10).cast("long"), F.lit(254)) + 1).cast("string")
    ip = F.concat_ws(".", *[octet(k) for k in range(4)])

    def name(script: str) -> Column:
        syllables = F.array(*[F.lit(s) for s in SYLLABLES[script]])
        picks = F.transform(F.sequence(F.lit(1), 2 + F.floor(nonce / 8).cast("int")), lambda k: F.element_at(
            syllables, F.conv(F.substring(h, F.pmod(k, F.lit(128)) + 1, F.lit(1)), 16, 10).cast("int") + 1))
        ending = _cases([(kind == f"{role} {sc} {g}", F.lit(e)) for (role, sc, g), e in ENDINGS.items()], F.lit(""))
        return F.concat(F.array_join(picks, ""), ending)

    return _cases([(kind == "card", card), (kind == "ip", ip), (kind.contains(" Latn "), name("Latn")),
                   (kind.contains(" Cyrl "), name("Cyrl"))], plain)


def _shown(kind: Column, made: Column, shown: Column) -> Column:
    """A surrogate in the format of one mention: its letters and digits take
    the places, and the case, of the mention's."""
    def put(acc: Column, c: Column) -> Column:
        x = F.substring(made, acc["k"] + 1, F.lit(1))
        free = F.rlike(c, F.lit(r"[\p{L}\p{N}]"))
        return F.struct(F.concat(acc["out"], F.when(free, F.when(c != F.lower(c), F.upper(x)).otherwise(x)).otherwise(c)).alias("out"),
                        (acc["k"] + F.when(free, 1).otherwise(0)).alias("k"))

    value = F.regexp_extract(shown, r"[\"']([^\"'\s]+)[\"']$", 1)
    whole = made
    made_plain = F.when(kind == "email", F.regexp_replace(made, r"[^\p{L}\p{N}]", "")).otherwise(F.ltrim(made, F.lit("+")))
    made = F.when(kind == "secret", F.regexp_replace(made, r"[^\p{L}\p{N}]", "")).otherwise(made_plain)
    target = F.when(kind == "secret", value).otherwise(shown)
    zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("k"))
    # secrets and keys, which may be long, have a surrogate letter by letter
    cased = F.zip_with(F.split(target, ""), F.split(whole, ""), lambda c, x: F.when(c != F.lower(c), F.upper(x)).otherwise(x))
    filled = F.when(kind.isin("secret", "key") & (F.length(whole) == F.length(target)), F.array_join(cased, "")).otherwise(
        F.aggregate(F.split(target, ""), zero, put)["out"])
    secret = F.concat(F.substring(shown, F.lit(1), F.length(shown) - F.length(value) - 1), filled, F.substring(shown, -1, 1))
    return _cases([(kind == "", shown), (kind == "ip", made), (kind == "secret", secret),
                   (kind.contains(" "), F.initcap(made))], filled)


def assign(entities: DataFrame, key: str) -> DataFrame:
    """(type, norm, made) with a surrogate for each distinct entity (type,
    norm): distinct within its type and no entity itself."""
    spark = entities.sparkSession
    now = entities.select("type", "norm", F.lit(0).alias("nonce"))
    real = entities.select("type", F.col("norm").alias("made")).withColumn("real", F.lit(True))
    for _ in range(ROUNDS):
        drawn = written(now.withColumn("made", surrogate(F.col("type"), F.col("norm"), F.col("nonce"), key)),
                        work_dir(spark, "surrogates"))
        # the first entity that drew a value keeps it; one that kept its draw in an earlier round stays first
        first = drawn.groupBy("type", "made").agg(F.min(F.struct("nonce", "norm"))["norm"].alias("first"))
        held = drawn.join(first, ["type", "made"]).join(real, ["type", "made"], "left")
        clash = (F.col("norm") != F.col("first")) | F.col("real").isNotNull()
        held = written(held.select("type", "norm", "nonce", "made", clash.alias("clash")), work_dir(spark, "surrogates"))
        if held.filter("clash").isEmpty():
            return held.select("type", "norm", "made")
        now = held.select("type", "norm", (F.col("nonce") + F.col("clash").cast("int")).alias("nonce"))
    raise ValueError(f"no distinct surrogates after {ROUNDS} draws: a format has fewer values than entities")


def replace_entities(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with every entity in ``text_col`` replaced, and the number of
    replaced mentions."""
    spark = docs.sparkSession
    count, = fresh(docs, "n_replaced")
    if "n_replaced" not in {c.lower() for c in docs.columns}:
        count = "n_replaced"
    row, found, names, pattern = fresh(docs.withColumn(count, F.lit(0)), "row", "found", "names", "pattern")
    mentions = F.regexp_extract_all(F.col(text_col), F.lit(ANY), F.lit(0))
    has = F.coalesce(F.rlike(F.col(text_col), F.lit(HINT)) & F.rlike(F.col(text_col), F.lit(ANY)), F.lit(False))
    held = docs.filter(has).withColumn(row, F.monotonically_increasing_id()).withColumn(found, mentions)
    held = held.withColumn(names, _names(F.col(found)))
    held = held.withColumn(pattern, F.when(F.size(names) > 0, _with_names(F.col(names))))
    held = held.withColumn(found, F.when(F.col(pattern).isNull(), F.col(found))
                           .otherwise(F.regexp_extract_all(F.col(text_col), F.col(pattern), F.lit(0))))
    held = written(held, work_dir(spark, "mentions"))
    parts = held.select(F.col(row).alias("row"), F.col(names).alias("names"), F.posexplode(found).alias("at", "mention"))
    parts = parts.select("row", "at", F.posexplode(_parts(F.col("mention"), F.col("names"))).alias("part", "p"))
    parts = written(parts.select("row", "at", "part", "p.*"), work_dir(spark, "parts"))
    made = assign(parts.filter("type <> ''").select("type", "norm").distinct(), key)
    met = join_hot(parts, made, ["type", "norm"], "left").select(
        "row", "at", "part", F.when(F.col("made").isNull(), F.col("shown"))
        .otherwise(_shown(F.col("type"), F.col("made"), F.col("shown"))).alias("shown"))
    lists = met.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "part", "shown"))).alias("new"))
    lists = lists.select(F.col("row").alias(row), F.transform("new", lambda x: F.struct(
        x["at"].alias("at"), x["part"].alias("part"), x["shown"].alias("shown"))).alias("new"))
    pieces = F.when(F.col(pattern).isNull(), F.split(F.col(text_col), ANY, -1)).otherwise(
        F.split(F.col(text_col), F.col(pattern), -1))
    new, = fresh(held, "new")
    put = F.transform(F.col(new), lambda x: F.concat(
        F.when(x["part"] == 0, F.get(pieces, x["at"])).otherwise(F.lit(" ")), x["shown"]))
    text = F.concat(F.array_join(put, ""), F.element_at(pieces, -1))
    replaced = held.join(lists.withColumnRenamed("new", new), row).withColumn(count, F.size(found).cast("long"))
    replaced = replaced.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns], count)
    return docs.filter(~has).withColumn(count, F.lit(0).cast("long")).unionByName(replaced)
