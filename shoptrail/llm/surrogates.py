"""Personal data replaced by surrogates, with DataFrame functions only.

Every entity gets a surrogate of its own type and format, made from a key and the entity's normal form, so
that the same person, number or address is the same everywhere, however it is written. Surrogates that meet
each other or a real value are made anew until all are distinct.

Types: e-mail address, credential (password, key, token), IBAN, IPv4 address, card number, phone number, and a
name after a title: all its words, with initials, hyphens, apostrophes and the particles between them. Names keep
gender, script and capitals; later mentions of such a name in its document follow it, but for initials and single letters.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.common import let, written

# Patterns, tried in this order at each place. Runs are entered at their start only and
# without going back, so long runs of letters or digits take linear time.
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
TITLES = {
    "m": ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Don", "господин", "κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mademoiselle", "Señora", "Señorita", "Doña", "госпожа", "κυρία"],
    "n": ["Mx", "Dr", "Prof"],
}
# Domains of any number of labels are run through as a loop; what ends in a label that no domain ends in is tried up to
# the last one that may be.
LABEL = r"[A-Za-z0-9]++(?:-++[A-Za-z0-9]++)*+"
_ANY_TITLE = "|".join(t for titles in TITLES.values() for t in titles)
TITLED = rf"(?:{_ANY_TITLE})\.? (?:(?:Dr|Prof)\.? )*+"
# Name words: initials, or a capital and all letters up to the word's end; no possessive s. The particles stay as they are.
PARTICLE = r"(?:van|von|de|del|della|di|da|dos|du|bin|ibn|ter|ten)(?: (?:der|den|dem|la|las|los|le))?+"
INITIALS = r"\p{Lu}\.(?:[-‐‑]?\p{Lu}\.)*+"
NAME_WORD = r"(?:d['’])?+\p{Lu}[\p{L}\p{M}]*+(?:['’](?!s(?!\p{L}))\p{L}[\p{L}\p{M}]*+|[-‐‑]\p{Lu}[\p{L}\p{M}]*+)*+"
_NAME_PART = rf"(?:{PARTICLE} )?+(?:{INITIALS}|{NAME_WORD})"
# A run of name words ends before another title and before "I".
_NAME_STOP = rf"(?!(?:{_ANY_TITLE.replace('|Don|', '|')})\.? \p{{Lu}}|I(?![\p{{L}}.]))"
PATTERNS = {
    "email": rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:{LABEL}(?:\.{LABEL})*+(?<=\.[A-Za-z]{{2,24}})|(?:[A-Za-z0-9-]++\.){{1,16}}[A-Za-z]{{2,}})",
    "secret": r"(?<![A-Za-z])(?i:password|passwd|secret|token|api[_-]?key)(?:=|:[ ]?|[ ]?=[ ]?|[ ]\"|[ ]')[A-Za-z0-9_+/-]{8,}+|(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": rf"(?<![0-9.]){OCTET}(?:\.{OCTET}){{3}}(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9])[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{1,7}(?![0-9])|(?<![A-Za-z0-9])[0-9]{13,19}(?![A-Za-z0-9])",
    "phone": r"(?<![A-Za-z0-9+])\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{2,4}\)?){2,5}(?![0-9])|(?<![A-Za-z0-9])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "name": rf"(?<!\p{{L}}){TITLED}{_NAME_PART}(?: {_NAME_STOP}{_NAME_PART})*+",
}
# Names are built from syllables of the script they replace; given names get an ending of their gender.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ka ke la le lo ma me mi na ne no ra re ri ro sa se ta te to va".split(),
    "cyrillic": "ба бе бо да де до га го ка ке ла ле ло ма ме ми на не но ра ре ри ро са се та те то ва".split(),
    "greek": "βα βε γα γο δα δε κα κε λα λε λο μα με μι να νε νο ρα ρε ρι ρο σα σε τα τε το φα".split(),
}
ENDINGS = {
    "latin": {"m": ["ko", "lus", "ner", "bert"], "f": ["lia", "na", "ra", "sa"], "n": ["li", "ni", "ri", "sen"]},
    "cyrillic": {"m": ["лис", "мир", "рон", "сей"], "f": ["лия", "на", "ра", "са"], "n": ["ко", "ли", "ни", "ри"]},
    "greek": {"m": ["λος", "νης", "ρος", "σης"], "f": ["λα", "νη", "ρα", "σα"], "n": ["λι", "νι", "ρι", "σι"]},
}
RELAXED = 20
SECRET_VALUE = r"([A-Za-z0-9_+/-]+)$"
ANY = "|".join(PATTERNS.values())


def mentions(text: Column, pattern: Column | None = None) -> Column:
    """All entities of a text as they stand in it, in order."""
    return F.regexp_extract_all(text, F.lit(ANY) if pattern is None else pattern, F.lit(0))


def _kind(mention: Column) -> Column:
    tests = [F.when(mention.rlike(f"^(?:{pattern})$"), name) for name, pattern in PATTERNS.items()]
    return F.coalesce(*tests, F.lit("name"))


def _last(text: Column, n: int) -> Column:
    return F.reverse(F.substring(F.reverse(text), 1, n))


def _name_entities(mention: Column) -> Column:
    """The words of a titled name in order, as ``kind``, ``norm`` (lower case), ``gender`` (of given names, as the title shows
    it) and ``word``; particles are of no kind. A word is the same name wherever it stands in a name."""
    title = F.regexp_extract(mention, r"^([^ .]+)", 1)
    gender = F.when(title.isin(TITLES["m"]), "m").when(title.isin(TITLES["f"]), "f").otherwise("n")
    words = F.split(F.regexp_replace(mention, f"^{TITLED}", ""), " ")

    def entity(word: Column, left: Column) -> Column:
        kind = F.when((left == 1) | word.rlike(r"^(?:d['’])?\p{Lu}"), "name")
        return F.struct(kind.alias("kind"), F.lower(word).alias("norm"), F.when(left > 1, gender).otherwise("n").alias("gender"), word.alias("word"))

    return let(words, lambda words: F.transform(words, lambda word, i: entity(word, F.size(words) - i)))


def parts(mention: Column) -> Column:
    """The entities in a mention, as ``kind``, the normal form ``norm`` that all their spellings share, and ``gender``.

    Lower case for addresses and names, digits for cards, the last ten digits for phones; each word of a name is one.
    """
    kind = _kind(mention)
    digits = F.regexp_replace(mention, "[^0-9]", "")
    norm = (
        F.when(kind == "email", F.lower(mention))
        .when(kind == "card", digits)
        .when(kind == "phone", _last(digits, 10))
        .when(kind == "iban", F.regexp_replace(mention, " ", ""))
        .when(kind == "secret", F.regexp_extract(mention, SECRET_VALUE, 1))
        .otherwise(mention)
    )
    names = F.transform(F.filter(_name_entities(mention), lambda e: e["kind"].isNotNull()), lambda e: F.struct(e["kind"], e["norm"], e["gender"]))
    return F.when(kind == "name", names).otherwise(F.array(F.struct(kind.alias("kind"), norm.alias("norm"), F.lit("n").alias("gender"))))


def _stream(*seed: Column) -> Column:
    """64 keyed pseudo-random bytes as hexadecimal text."""
    text = F.concat_ws("|", *seed)
    return F.concat(F.sha2(F.concat(text, F.lit("|0")), 256), F.sha2(F.concat(text, F.lit("|1")), 256))


def _byte(stream: Column, i: Column) -> Column:
    return F.conv(F.substring(stream, (2 * (i % 64) + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _alike(text: Column, stream: Column) -> Column:
    """``text`` with each digit, small and capital letter replaced by another of its class."""

    def swap(c: Column, i: Column, s: Column) -> Column:
        letter = lambda first: F.char(_byte(s, i) % 26 + first)
        digit = (_byte(s, i) % 10).cast("string")
        return F.when(c.rlike("^[0-9]$"), digit).when(c.rlike("^[a-z]$"), letter(97)).when(c.rlike("^[A-Z]$"), letter(65)).otherwise(c)

    # Keyed bytes of a long text are costly: once, not per character.
    return let(stream, lambda s: F.array_join(F.transform(F.split(text, ""), lambda c, i: swap(c, i, s)), ""))


def _luhn_sum(digits: Column) -> Column:
    """The Luhn sum of digits that a check digit follows."""
    doubled = lambda d, i: F.when(i % 2 == 0, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)
    values = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c, i: doubled(c.cast("int"), i))
    return F.aggregate(values, F.lit(0), lambda total, d: total + d)


def _check_digit(digits: Column) -> Column:
    return ((10 - _luhn_sum(digits) % 10) % 10).cast("string")


def _card(norm: Column, stream: Column) -> Column:
    """Same length and first digit; a right check digit if the card had one."""
    body = F.concat(F.substring(norm, 1, 1), _alike(F.expr("substring(norm, 2, length(norm) - 2)"), stream))
    valid = _last(norm, 1) == _check_digit(F.expr("substring(norm, 1, length(norm) - 1)"))
    return F.concat(body, F.when(valid, _check_digit(body)).otherwise((_byte(stream, F.lit(63)) % 10).cast("string")))


def _email(norm: Column, stream: Column, key: str) -> Column:
    """Local part of the same shape; a domain keyed by itself, so one domain stays one, with its last label."""
    domain = F.regexp_extract(norm, r"@(.*)\.[^.]+$", 1)
    local = _alike(F.regexp_extract(norm, "^([^@]*)@", 1), stream)
    # Short addresses are few: later attempts are longer.
    local = F.concat(local, F.when(F.col("attempt") > 2, F.substring(stream, F.lit(65), F.col("attempt") - 2)).otherwise(""))
    return F.concat(local, F.lit("@"), _alike(domain, _stream(F.lit(key), F.lit("domain"), domain)), F.regexp_extract(norm, r"(\.[^.]+)$", 1))


def _name(word: Column, gender: Column, attempt: Column, stream: Column) -> Column:
    """Syllables of the same script, one more for each attempt; an ending of the name's gender. In lower case."""

    def built(script: str) -> Column:
        pick = lambda values, i: F.element_at(F.array(*map(F.lit, values)), _byte(stream, i) % len(values) + 1)
        body = F.array_join(F.transform(F.sequence(F.lit(1), attempt + 2), lambda i: pick(SYLLABLES[script], i)), "")
        ends = ENDINGS[script]
        end = F.when(gender == "m", pick(ends["m"], F.lit(0))).when(gender == "f", pick(ends["f"], F.lit(0))).otherwise(pick(ends["n"], F.lit(0)))
        return F.concat(body, end)

    cyrillic, greek = word.rlike(r"\p{IsCyrillic}"), word.rlike(r"\p{IsGreek}")
    return F.when(cyrillic, built("cyrillic")).when(greek, built("greek")).otherwise(built("latin"))


def _surrogate(key: str) -> Column:
    """The surrogate of the columns ``kind``, ``norm`` at ``attempt``, in normal form."""
    kind, norm, attempt, gender = (F.col(c) for c in ("kind", "norm", "attempt", "gender"))
    stream = _stream(F.lit(key), kind, norm, attempt.cast("string"))
    octets = F.concat_ws(".", *((_byte(stream, F.lit(i)) % 254 + 1).cast("string") for i in range(4)))
    hexadecimal = F.array_join(F.transform(F.split(norm, ""), lambda c, i: F.when(c == "", "").otherwise(F.substring(stream, (i % 128 + 1).cast("int"), F.lit(1)))), "")
    return (
        F.when(kind == "email", _email(norm, stream, key))
        .when(kind == "ip", octets)
        .when(kind == "card", _card(norm, stream))
        .when((kind == "secret") & norm.rlike("^[0-9a-f]+$"), hexadecimal)
        .when(kind == "iban", F.concat(F.substring(norm, 1, 2), _alike(F.substring(norm, 3, 1_000_000), stream)))
        .when(kind == "name", _name(norm, gender, attempt, stream))
        .otherwise(_alike(norm, stream))
    )


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """``kind``, ``norm``, ``surrogate`` for the distinct (``kind``, ``norm``) of ``entities``.

    A surrogate equals no other one and no real value of its kind; of entities that meet, the first keeps it and
    the others get the next of their own sequence, until none meet. A name's surrogate has the ``gender`` (``m``, ``f``) of
    its titles, where they agree. Where the values of a format are nearly used up, real values are taken too from
    ``RELAXED`` attempts on.
    """
    entities = entities if "gender" in entities.columns else entities.withColumn("gender", F.lit("n"))
    shown = lambda g: F.max((F.col("gender") == g).cast("int"))
    state = entities.groupBy("kind", "norm").agg(shown("m").alias("m"), shown("f").alias("f"))
    gender = F.when(F.col("m") > F.col("f"), "m").when(F.col("f") > F.col("m"), "f").otherwise("n")
    state = state.select("kind", "norm", gender.alias("gender"), F.lit(0).alias("attempt"))
    state = written(state.withColumn("surrogate", _surrogate(key)), "surrogates")
    real = state.select("kind", F.col("norm").alias("surrogate"), F.lit(True).alias("real"))
    while True:
        first = state.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "norm")).alias("first"))
        checked = state.join(first, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left")
        again = (F.col("real").isNotNull() & (F.col("attempt") < RELAXED)) | (F.col("first") != F.struct("attempt", "norm"))
        checked = written(checked.select("kind", "norm", "gender", "attempt", "surrogate", again.alias("again")), "surrogates")
        if checked.filter("again").isEmpty():
            return checked.select("kind", "norm", "surrogate")
        anew = checked.filter("again").select("kind", "norm", "gender", (F.col("attempt") + 1).alias("attempt"))
        state = checked.filter("not again").drop("again").unionByName(anew.withColumn("surrogate", _surrogate(key)))


def _refilled(mention: Column, chars: Column) -> Column:
    """``mention`` with its last letters and digits replaced by ``chars``; signs stay where they are."""
    source = F.split(F.reverse(mention), "")
    fill = F.reverse(chars)

    def step(done: Column, c: Column) -> Column:
        taken = c.rlike("^[A-Za-z0-9]$") & (done["k"] < F.length(fill))
        new = F.when(taken, F.substring(fill, done["k"] + 1, F.lit(1))).otherwise(c)
        return F.struct(F.concat(done["out"], new).alias("out"), (done["k"] + taken.cast("int")).alias("k"))

    return F.reverse(F.aggregate(source, F.struct(F.lit("").alias("out"), F.lit(0).alias("k")), step, lambda done: done["out"]))


def _as_initials(word: Column, name: Column) -> Column:
    """``word`` with its letters replaced by capitals of ``name``; dots and hyphens stay."""
    letter = lambda i: F.upper(F.substring(name, i % F.length(name) + 1, F.lit(1)))
    return F.array_join(F.transform(F.split(word, ""), lambda c, i: F.when(c.rlike(r"^\p{L}$"), letter(i)).otherwise(c)), "")


def _cased(word: Column, value: Column) -> Column:
    """``value`` as the mention ``word`` is written: all in capitals, or with the first one."""
    return F.when((F.length(word) > 1) & (word == F.upper(word)), F.upper(value)).otherwise(F.initcap(value))


def _rewritten(mention: Column, known: Column) -> Column:
    """A mention in its own format with the surrogates of the map ``known`` (by kind and normal form)."""
    found = parts(mention)
    new = F.transform(found, lambda p: F.element_at(known, F.concat_ws(":", p["kind"], p["norm"])))
    kind, norm, value = F.element_at(found, 1)["kind"], F.element_at(found, 1)["norm"], F.element_at(new, 1)

    def renamed(e: Column) -> Column:
        word, value = e["word"], F.element_at(known, F.concat_ws(":", e["kind"], e["norm"]))
        return F.when(e["kind"].isNull(), word).when(word.contains("."), _as_initials(word, value)).otherwise(_cased(word, value))

    name = F.concat(F.regexp_extract(mention, f"^({TITLED})", 1), F.array_join(F.transform(_name_entities(mention), renamed), " "))
    return (
        F.when(kind == "name", name)
        .when(kind.isin("card", "phone", "iban"), _refilled(mention, value))
        .when(kind == "secret", F.concat(F.substring(mention, F.lit(1), F.length(mention) - F.length(norm)), value))
        .when((kind == "email") & (mention == F.upper(mention)), F.upper(value))
        .otherwise(value)
    )


def _interleaved(text: Column, pattern: Column, new: Column) -> Column:
    """``text`` with the matches of ``pattern`` replaced by the values of ``new``, in order."""
    pieces = F.split(text, pattern, -1)
    return F.array_join(F.zip_with(pieces, new, lambda piece, value: F.concat(piece, F.coalesce(value, F.lit("")))), "")


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with surrogates in ``text``, all their columns, and the number of ``replaced`` mentions.

    Texts without an entity, null and empty ones come back as they are (0 replaced). An older column named
    ``replaced`` is replaced. Rows need no id: entities are brought back to their texts by the text's hash.
    """
    columns = [c for c in docs.columns if c != "replaced"]
    docs = docs.select(*columns)
    has = F.coalesce(F.col("text").rlike(ANY), F.lit(False))
    plain = docs.filter(~has).withColumn("replaced", F.lit(0))
    hits = docs.filter(has).select(F.struct(*columns).alias("row"), F.col("text").alias("body"))
    hits = hits.withColumn("hash", F.xxhash64("body")).withColumn("found", mentions(F.col("body")))
    hits = written(hits.withColumn("entities", F.array_distinct(F.flatten(F.transform("found", parts)))), "entities")
    rows = hits.select("hash", F.explode("entities").alias("e")).select("hash", "e.kind", "e.norm", "e.gender").distinct()
    rows = written(rows, "entity-rows")
    table = surrogate_table(rows, key)
    named = F.concat_ws(":", "kind", "norm")
    entry = F.struct(named.alias("entity"), "surrogate", "kind", F.col("norm").alias("word"))
    known = rows.select("hash", "kind", "norm").distinct().join(table, ["kind", "norm"]).groupBy("hash").agg(F.collect_set(entry).alias("entries"))
    filled = hits.join(known, "hash")
    mapping = F.map_from_entries(F.transform("entries", lambda e: F.struct(e["entity"], e["surrogate"])))
    new = let(mapping, lambda known: F.transform("found", lambda m: _rewritten(m, known)))
    filled = filled.withColumn("body", _interleaved(F.col("body"), F.lit(ANY), new))
    # Later mentions of a name, without its title, in any case from a capital on; the longest first, as one may start
    # with another.
    follows = lambda e: (e["kind"] == "name") & (F.length(e["word"]) > 1) & ~e["word"].contains(".")
    ranked = lambda e: F.struct((-F.length(e["word"])).alias("rank"), *(e[c].alias(c) for c in ("entity", "surrogate", "kind", "word")))
    names = F.array_sort(F.transform(F.filter("entries", follows), ranked))
    filled = filled.withColumn("names", names)
    capital = r"(?<!\p{L})(?=(?:d['’])?\p{Lu})(?iu:"
    bare = F.concat(F.lit(capital), F.array_join(F.transform("names", lambda e: e["word"]), "|"), F.lit(r")(?!\p{L})"))
    value = lambda m: F.get(F.filter("names", lambda e: e["word"] == F.lower(m)), F.lit(0))["surrogate"]
    other = F.transform(mentions(F.col("body"), bare), lambda m: F.coalesce(_cased(m, value(m)), m))
    body = F.when(F.size("names") > 0, _interleaved(F.col("body"), bare, other)).otherwise(F.col("body"))
    count = F.size("found") + F.when(F.size("names") > 0, F.size(mentions(F.col("body"), bare))).otherwise(0)
    kept = [body.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in columns]
    return plain.unionByName(filled.select(*kept, count.alias("replaced")))
