"""Personal data replaced by keyed surrogates of the same type, format, script and gender."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import query
from tablewright.llm.documents import documents
from tablewright.llm.durable import durable, unused

# Titles that go before a name, by gender, and words that go before a secret.
_MALE = "Mr Mister Herr Monsieur Señor Sr Don господин г-н κύριος".split()
_FEMALE = "Mrs Ms Miss Frau Madame Mme Mlle Señora Señorita Sra Srta Doña госпожа г-жа κυρία".split()
_EITHER = "Dr Prof Professor".split()
_SECRET_WORDS = "password passwd pwd secret token api_key api-key apikey access_key passphrase".split()

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_NAME = r"\p{Lu}[\p{L}'’-]*\p{Ll}"
#: What is found, in the order in which it is tried at a place.
PATTERNS = {
    "email": r"[\p{L}0-9][\p{L}0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "secret": rf"(?i:(?<![a-z])(?:{'|'.join(_SECRET_WORDS)}))\s{{0,3}}[=:]\s{{0,3}}[\"']?"
              r"(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{6,}",
    "access": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])",
    "phone": r"(?<![0-9.])\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"
             r"|(?<![0-9.])\+[0-9]{1,3}(?:[ .-][0-9]{1,3}){4,5}(?![0-9.])"
             r"|(?<![0-9.])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])|(?<![0-9.-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9-])",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[ -]?[0-9]{4}){3}(?![0-9])",
    "social": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "person": rf"(?<!\p{{L}})(?:{'|'.join(_MALE + _FEMALE + _EITHER)})\.? {_NAME}(?: {_NAME})?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
_TITLE = rf"^(?:{'|'.join(_MALE + _FEMALE + _EITHER)})\.? "
#: What an entity keeps: country codes, issuers, private networks, the words before a secret.
_KEPT = {
    "secret": r"^.*[=:]\s*[\"']?", "access": r"^.{4}", "phone": r"^\+[0-9]{1,3}(?=[ .(-])|^\+[0-9]", "card": r"^[0-9]",
    "iban": r"^[A-Z]{2}", "ip": r"^(?:10\.|127\.|192\.168\.|172\.(?:1[6-9]|2[0-9]|3[01])\.)?", "social": "^",
}
#: Names are built from syllables by script; endings tell the gender.
_SYLLABLES = {
    "latin": ("b d f g h k l m n p r s t v z br dr kl st tr".split(), "a e i o u".split(),
              {"male": "n r s d l x".split(), "female": "na ra ia la sa ena".split(), "either": "n l r s m t".split()}),
    "cyrillic": ("б в г д ж з к л м н п р с т ф х бр др ст тр".split(), "а е и о у".split(),
                 {"male": "н р с в л м".split(), "female": "на ра ия ла са ва".split(), "either": "н л р с м т".split()}),
    "greek": ("β γ δ ζ θ κ λ μ ν π ρ σ τ φ χ ψ".split(), "α ε ι ο υ".split(),
              {"male": "ς ν ρ".split(), "female": "να ρα ια".split(), "either": "ν ς ρ".split()}),
}
_LONGER_AFTER = 8


def _array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _unit(kind: Column, lead: Column, body: Column, scope: Column, name: Column) -> Column:
    return F.struct(kind.alias("kind"), lead.alias("lead"), body.alias("body"), scope.alias("scope"), name.alias("name"))


def _letters(body: Column) -> Column:
    return F.lower(F.regexp_replace(body, "[^A-Za-z0-9]", ""))


def _parts(entity: Column) -> Column:
    """An entity as units: text kept as it is (lead), then a body to replace, named by (kind, scope, name)."""
    none = F.lit("")
    cases = []
    for kind, kept in _KEPT.items():
        lead = F.regexp_extract(entity, kept, 0)
        body = F.substring(entity, F.length(lead) + 1, F.length(entity))
        cases.append((entity.rlike(f"^(?:{PATTERNS[kind]})$"),
                      F.array(_unit(F.lit(kind), lead, body, none, F.when(F.lit(kind == "ip"), body).otherwise(_letters(body))))))
    local, domain = F.substring_index(entity, "@", 1), F.substring_index(entity, "@", -1)
    labels = F.regexp_replace(domain, r"\.[^.]*$", "")
    email = F.array(_unit(F.lit("local"), none, local, F.lower(domain), F.lower(local)),
                    _unit(F.lit("domain"), F.lit("@"), labels, none, F.lower(domain)),
                    _unit(F.lit("kept"), F.lit(".example"), none, none, none))
    out = F.when(entity.contains("@"), email)
    for test, value in cases:
        out = out.when(test, value)
    return out.otherwise(_person(entity))


def _person(entity: Column) -> Column:
    """The units of a title and name: a given name, if there are two, and a family name."""
    none = F.lit("")
    title = F.regexp_extract(entity, r"^[^ ]+ ", 0)
    names = F.split(F.substring(entity, F.length(title) + 1, F.length(entity)), " ")
    plain = F.regexp_replace(title, r"[. ]", "")
    gender = F.when(plain.isin(_MALE), "male").when(plain.isin(_FEMALE), "female").otherwise("either")
    script = F.when(names[0].rlike(r"\p{IsCyrillic}"), "cyrillic").when(names[0].rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    given = F.concat(F.lit("given/"), script, F.lit("/"), gender)
    # Latin family names are the same for all genders, so every title leads to one surrogate.
    family = F.concat(F.lit("family/"), script, F.lit("/"), F.when(script == "latin", "either").otherwise(gender))
    surname = F.element_at(names, -1)
    return F.filter(F.array(
        F.when(F.size(names) > 1, _unit(given, title, names[0], none, F.lower(names[0]))),
        _unit(family, F.when(F.size(names) > 1, " ").otherwise(title), surname, none, F.lower(surname))), lambda u: u.isNotNull())


def entities(text: Column) -> Column:
    """The entities of a text, in order; texts without a sign of any are not searched."""
    signs = [text.rlike("[0-9@]")] + [text.contains(t) for t in _MALE + _FEMALE + _EITHER]
    signs += [F.lower(text).contains(w) for w in ("passw", "pwd", "secret", "token", "key", "passphrase")]
    return F.when(reduce(lambda a, b: a | b, signs), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(
        F.array().cast("array<string>"))


def mentions(df: DataFrame, text: Column, out: str) -> DataFrame:
    """Adds ``out``: what is found in a text, as (text between, units in order), null where nothing is.

    A name found with a title is looked for in the whole text, and every mention has the
    same units: those of one gender, where any of its titles tells it.
    """
    found, people, names = (unused(df, f"{out}_{c}") for c in ("found", "people", "names"))
    df = df.withColumn(found, entities(text))
    named = F.filter(F.col(found), lambda e: e.rlike(_TITLE))
    df = df.withColumn(people, F.when(F.size(named) > 0, F.flatten(F.transform(named, _person))))
    bare = F.concat(F.lit(ANY + r"|(?<!\p{L})(?:"), F.array_join(F.array_distinct(F.transform(F.col(people), lambda u: u["body"])), "|"),
                    F.lit(r")(?!\p{L})"))
    df = df.withColumn(names, F.when(F.col(people).isNotNull(), bare))
    every = F.when(F.col(names).isNull(), F.col(found)).otherwise(F.regexp_extract_all(text, F.col(names), F.lit(0)))

    def as_known(unit: Column, name: Column) -> Column:
        """The unit under the surest kind that the text's titles give its name."""
        kinds = F.transform(F.filter(F.col(people), lambda p: (p["name"] == name) & (
            unit["kind"].isNull() | (F.substring_index(p["kind"], "/", 2) == F.substring_index(unit["kind"], "/", 2)))),
            lambda p: F.struct(p["kind"].endswith("/either").alias("either"), p["kind"].alias("kind")))
        return _unit(F.coalesce(F.array_min(kinds)["kind"], unit["kind"]), unit["lead"], unit["body"], unit["scope"], unit["name"])

    def of(entity: Column) -> Column:
        unknown = _unit(F.lit(None).cast("string"), F.lit(""), entity, F.lit(""), F.lower(entity))
        alone = F.exists(F.col(people), lambda p: p["body"] == entity)
        return F.when(F.coalesce(alone, F.lit(False)), F.array(as_known(unknown, F.lower(entity)))).otherwise(
            F.transform(_parts(entity), lambda u: F.when(F.col(people).isNull() | ~u["kind"].contains("/"), u).otherwise(as_known(u, u["name"]))))

    gaps = F.when(F.col(names).isNull(), F.split(text, ANY, -1)).otherwise(F.split(text, F.col(names), -1))
    return df.withColumn(out, F.when(F.size(found) > 0, F.struct(gaps.alias("gaps"), F.transform(every, of).alias("units")))).drop(
        found, people, names)


def _byte(stream: Column, i: Column) -> Column:
    return F.conv(F.substring(stream, (i % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _stream(key: str, unit: Column, attempt: Column) -> Column:
    """64 keyed bytes as hexadecimal digits, from the identity of the unit and the attempt."""
    inner = F.sha2(F.concat_ws("\x00", F.lit(key), unit["kind"], unit["scope"], unit["name"], attempt.cast("string")), 256)
    return F.sha2(F.concat(F.lit(key), inner), 512)


def _pick(values: list[str], at: Column) -> Column:
    return F.element_at(_array(values), (at % len(values) + 1).cast("int"))


def _spoken(onsets: list[str], vowels: list[str], stream: Column, last: Column) -> Column:
    def syllable(i: Column) -> Column:
        return F.concat(_pick(onsets, _byte(stream, i * 2)), _pick(vowels, _byte(stream, i * 2 + 1)))

    return F.array_join(F.transform(F.sequence(F.lit(0), last), syllable), "")


def _char(shape: Column, byte: Column, hexadecimal: Column) -> Column:
    letters = F.when(hexadecimal, F.substring(F.lit("abcdef"), byte % 6 + 1, F.lit(1))).otherwise(F.char(byte % 26 + 97))
    return F.when(shape.rlike("[0-9]"), (byte % 10).cast("string")).otherwise(letters)


def surrogate(key: str, unit: Column, attempt: Column) -> Column:
    """The new body of a unit: letters for letters, digits for digits, marks where they were.

    Octets stay octets and names become names of their script and gender. From some
    attempt on the body grows, so that a free one is always found.
    """
    stream, body, kind = _stream(key, unit, attempt), unit["body"], unit["kind"]
    more = F.greatest(attempt - (_LONGER_AFTER - 1), F.lit(0))
    hexadecimal = ~F.lower(body).rlike("[g-z]")
    base = F.concat(body, F.repeat(F.regexp_extract(body, "([A-Za-z0-9])[^A-Za-z0-9]*$", 1), more))

    def coded(i: Column) -> Column:
        c = F.substring(base, i, F.lit(1))
        # Marks are not counted, so one number in two formats gets one surrogate in both.
        k = F.length(F.regexp_replace(F.substring(base, F.lit(1), i), "[^A-Za-z0-9]", "")) - 1
        new = _char(c, _byte(stream, k), hexadecimal)
        return F.when(c.rlike("[A-Z]"), F.upper(new)).when(c.rlike("[a-z0-9]"), new).otherwise(c)

    code = F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.length(base), F.lit(1))), coded), "")
    octets = F.array_join(F.transform(F.split(body, r"\."), lambda _, i: (_byte(stream, i) % 254 + 1).cast("string")), ".")
    name = F.lit("")
    for script, (onsets, vowels, endings) in _SYLLABLES.items():
        syllables = _spoken(onsets, vowels, stream, F.lit(2) + more)
        ending = F.lit("")
        for gender, last in endings.items():
            ending = F.when(kind.endswith("/" + gender), _pick(last, _byte(stream, F.lit(63)))).otherwise(ending)
        name = F.when(kind.contains(f"/{script}/"), F.initcap(F.concat(syllables, ending))).otherwise(name)
    checked = F.when(kind == "card", _card(unit, code)).when(kind == "iban", _iban(unit, code)).otherwise(code)
    return F.when(kind == "kept", "").when(kind == "ip", octets).when(kind.contains("/"), name).otherwise(checked)


def _remainder(number: Column) -> Column:
    """What is left of an account number (letters count from 10) after division by 97."""
    chars = F.filter(F.split(F.upper(number), ""), lambda c: c.rlike("[0-9A-Z]"))
    return F.aggregate(chars, F.lit(0), lambda left, c: F.when(c.rlike("[0-9]"), (left * 10 + F.ascii(c) - 48) % 97)
                       .otherwise((left * 100 + F.ascii(c) - 55) % 97))


def _iban(unit: Column, code: Column) -> Column:
    """The account number with right check digits, if it had them before."""
    def turned(body: Column, digits: Column) -> Column:
        return F.concat(F.substring(body, F.lit(3), F.length(body)), unit["lead"], digits)

    right = F.lpad((98 - _remainder(turned(code, F.lit("00")))).cast("string"), 2, "0")
    was_right = _remainder(turned(unit["body"], F.substring(unit["body"], 1, 2))) == 1
    return F.when(was_right, F.concat(right, F.substring(code, F.lit(3), F.length(code)))).otherwise(code)


def _luhn(number: Column) -> Column:
    """The check sum of a card number, last digit included, modulo 10."""
    digits = F.reverse(F.filter(F.split(number, ""), lambda c: c.rlike("[0-9]")))
    doubled = F.transform(digits, lambda c, i: F.when(i % 2 == 0, F.ascii(c) - 48).otherwise(
        (F.ascii(c) - 48) * 2 - F.when(F.ascii(c) >= 53, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + d) % 10


def _card(unit: Column, code: Column) -> Column:
    """The card number with a right check digit, if it had one before."""
    front = F.substring(code, F.lit(1), F.length(code) - 1)
    last = (10 - _luhn(F.concat(unit["lead"], front, F.lit("0")))) % 10
    was_right = _luhn(F.concat(unit["lead"], unit["body"])) == 0
    return F.when(was_right, F.concat(front, last.cast("string"))).otherwise(code)


def _identity(unit: Column) -> Column:
    return F.concat_ws("\x00", unit["kind"], unit["scope"], unit["name"])


def later_attempts(named: DataFrame, key: str) -> DataFrame:
    """(identity, attempt): units whose first surrogate is taken by another, or is what it replaces.

    ``named`` holds distinct units, with a body in small letters. In each round every
    surrogate stays with the unit that got it in the earliest attempt (then by name) and the
    others try again; most tables need no second round.
    """
    state = durable(named.withColumn("attempt", F.lit(0)).withColumn("new", surrogate(key, F.col("unit"), F.lit(0))))
    while True:
        owner = state.groupBy("unit.kind", "unit.scope", "new").agg(F.min(F.struct("attempt", "unit.name")).alias("owner"),
                                                                  F.count(F.lit(1)).alias("n"))
        taken = owner.filter("n > 1").select("kind", "scope", "new", "owner")
        unit = F.col("unit")
        marked = (state.join(taken.withColumnsRenamed({"new": "taken"}),
                             (unit["kind"] == F.col("kind")) & (unit["scope"] == F.col("scope")) & (F.col("new") == F.col("taken")), "left")
                  .withColumn("lost", F.coalesce(F.struct("attempt", "unit.name") != F.col("owner"), F.lit(False))
                              | (F.col("new") == unit["body"])))
        # Step by step: inside a lambda, Spark would take "attempt" for an alias of the same select.
        following = marked.select("unit", "new", "lost", (F.col("attempt") + F.col("lost").cast("int")).alias("attempt"))
        following = durable(following.withColumn(
            "new", F.when(F.col("lost"), surrogate(key, F.col("unit"), F.col("attempt"))).otherwise(F.col("new"))))
        if following.filter("lost").isEmpty():
            return state.filter("attempt > 0").select(_identity(unit).alias("identity"), "attempt")
        state = following.drop("lost")


def replace_entities(df: DataFrame, key: str, text_col: str = "text", count_col: str = "n_surrogates") -> DataFrame:
    """``df`` with every detected entity of its text replaced, plus the number of entities.

    A surrogate is a keyed function of what an entity is, not of where or how it is
    written, so mentions agree within and across documents: a number keeps its surrogate in
    another format, a family name with or without a given name. A name found with a title is
    replaced wherever it stands in its text, and alike whatever the title. Card and account numbers
    with right check digits get right ones. Distinct entities of the
    corpus are then compared: where two got one surrogate, all but one try again
    until all differ. Only those later attempts are joined back to the texts that hold
    them; usually there are none and texts are never shuffled.

    Null text stays null, with no entities; texts without entities stay as they are.
    Ids play no part; repeated rows get one result each. Columns keep their names, whatever
    they are. An empty table gives an empty result. No Python runs on executors.
    """
    if not key:
        raise ValueError("surrogates need a key")
    text = F.col(f"`{text_col}`")
    held = unused(df, "mentions")
    rows = mentions(df, text, held)
    every = F.explode(F.flatten(F.col(f"{held}.units"))).alias("unit")
    found = mentions(df.select(text.alias("text")), F.col("text"), held).select(every).filter("unit.kind <> 'kept'")
    small = F.struct("unit.kind", F.lit("").alias("lead"), F.lower("unit.body").alias("body"), "unit.scope", "unit.name")
    named = found.groupBy(_identity(F.col("unit")).alias("identity")).agg(F.min(small).alias("unit")).select("unit")
    again = later_attempts(named, key)
    attempts, mark = unused(df, "attempts"), unused(df, "mark")
    if not again.isEmpty():
        of_text = (mentions(df.select(text.alias("text")), F.col("text"), held).select(F.md5("text").alias(mark), every)
                   .withColumn("identity", _identity(F.col("unit"))).join(again, "identity")
                   .groupBy(mark).agg(F.map_from_entries(F.collect_set(F.struct("identity", "attempt"))).alias(attempts)))
        rows = rows.withColumn(mark, F.md5(text)).join(of_text, mark, "left")
        attempt = lambda u: F.coalesce(F.try_element_at(F.col(attempts), _identity(u)), F.lit(0))
    else:
        attempt = lambda u: F.lit(0)
    new = F.transform(F.col(f"{held}.units"), lambda e: F.array_join(F.transform(
        e, lambda u: F.concat(u["lead"], surrogate(key, u, attempt(u)))), ""))
    rebuilt = F.array_join(F.zip_with(F.col(f"{held}.gaps"), new, lambda gap, entity: F.concat(gap, F.coalesce(entity, F.lit("")))), "")
    n = F.coalesce(F.size(f"{held}.units"), F.lit(0)).alias(count_col if count_col not in df.columns else unused(df, count_col))
    return rows.select(*[F.when(F.col(held).isNotNull(), rebuilt).otherwise(text).alias(c) if c == text_col else F.col(f"`{c}`")
                         for c in df.columns], n)


@query()
def op5_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    # The key of the check; a deployment passes its own secret.
    return replace_entities(documents(spark, folder).select("doc_id", "text"), "tablewright")
