"""Personal data: detected entities get keyed surrogates of their own kind, script, gender and format.

The surrogate is a function of the key and the entity's canonical form, so an entity reads the same wherever it
occurs. A person is found by a title; every word of a name has a surrogate of its own, and in a text that titles a person
their name is replaced without a title too: "Mr John Smith", "Smith" and "John" stay one person. Entities whose surrogates clash, with each other or with a real entity, are found over the whole table and drawn
anew until all differ. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import hashlib

from .common import free_name, let, small, total, written

#: Most rounds of drawing anew; each leaves only the few entities that clashed again.
ROUNDS = 40
#: Draws anew that keep an entity's length. Each later one is a character longer (of names a syllable): short entities may be as many as
#: there are texts of their length, and some have nothing that can be drawn.
SAME_LENGTH = 8

# Forms of address before a name, by the gender they tell.
TITLES = {"f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Mme", "Госпожа", "Κυρία"), "m": ("Mr", "Herr", "Señor", "Monsieur", "Господин", "Κύριος"), "n": ("Dr", "Prof", "Professor")}
# The patterns of each kind, in the order in which they are tried.
_NAME = r"\p{Lu}\p{L}+"
PATTERNS = {
    # possessive throughout: a repeated group that can give back is matched by recursion, one level a label
    "email": r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "iban": r"[A-Za-z]{2}\d{2}(?: ?[A-Za-z0-9]{4}){3,7}(?: ?[A-Za-z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ip": r"(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\p{L}\p{N}]|\.\d)",
    "phone": r"(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\) ?\d{3,4}[ .-]?\d{3,4}(?!\d)|\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)|\d{3}[.-]\d{3}[.-]\d{4}(?!\d)",
    "id": r"\d{3}-\d{2}-\d{4}(?!\d)",
    "card": r"\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}(?!\d)|\d{13,19}(?![\p{L}\p{N}])",
    "secret": r"(?=[A-Fa-f]*\d)(?=\d*[A-Fa-f])[0-9A-Fa-f]{32,64}(?![\p{L}\p{N}])",
    "name": "(?:" + "|".join(sorted(t for ts in TITLES.values() for t in ts)) + r")\.? " + _NAME + f"(?: {_NAME})?",
}
#: A title at the beginning.
_TITLE = "^(?:" + "|".join(sorted(t for ts in TITLES.values() for t in ts)) + r")\.? "
ENTITY = r"(?<![\p{L}\p{N}_@.+%-])(?:" + "|".join(f"(?:{p})" for p in PATTERNS.values()) + ")"


def kind_of(entity: Column) -> Column:
    """The first kind whose whole pattern the entity matches."""
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        out = F.when(F.regexp_like(entity, F.lit(f"^(?:{pattern})$")), F.lit(kind)).otherwise(out)
    return out


def canonical(kind: Column, entity: Column) -> Column:
    """What spellings of one entity have in common: lower case; of numbers the letters and digits. Names: see ``forms``."""
    bare = F.regexp_replace(F.lower(entity), r"[^\p{L}\p{N}]", "")
    return F.when(kind.isin("email", "ip", "secret"), F.lower(entity)).otherwise(bare)


def _stream(key: str, kind: Column, form: Column, attempt: Column, n: Column) -> Column:
    """At least ``n`` keyed pseudo-random bytes, as blocks of 32 in hexadecimal: HMAC-SHA256 of kind, form, attempt and block number."""
    secret = key.encode() if len(key.encode()) <= 64 else hashlib.sha256(key.encode()).digest()
    inner, outer = (bytes(b ^ pad for b in secret.ljust(64, b"\0")) for pad in (0x36, 0x5C))
    base = F.concat_ws("|", kind, form, attempt.cast("string"))

    def block(b: Column) -> Column:
        message = F.concat(base, F.lit("|"), b.cast("string")).cast("binary")
        return F.sha2(F.concat(F.lit(outer), F.unhex(F.sha2(F.concat(F.lit(inner), message), 256))), 256)

    return F.transform(F.sequence(F.lit(0), (n / 32).cast("int")), block)


def _byte(stream: Column, i: Column) -> Column:
    return F.conv(F.substr(F.get(stream, (i / 32).cast("int")), (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _luhn(digits: Column) -> Column:
    """The check digit of a card whose other digits are given."""
    n = F.length(digits)
    weighed = F.transform(F.split(digits, ""), lambda c, i: let(c.cast("long") * (1 + (n - i) % 2), lambda v: v - F.when(v > 9, 9).otherwise(0)))
    return F.pmod(-total(weighed), F.lit(10)).cast("string")


def _iban(form: Column) -> Column:
    """An IBAN in lower case with its check digits made right for its country and account."""
    turned = F.split(F.concat(F.substring(form, 5, 64), F.substring(form, 1, 2), F.lit("00")), "")
    digit = lambda c: F.regexp_like(c, F.lit("[0-9]"))
    rest = F.aggregate(turned, F.lit(0), lambda r, c: F.when(digit(c), (r * 10 + c.cast("int")) % 97).otherwise((r * 100 + F.ascii(c) - 87) % 97))
    return F.concat(F.substring(form, 1, 2), F.lpad((98 - rest).cast("string"), 2, "0"), F.substring(form, 5, 64))


def _pick(alphabet: str, v: Column) -> Column:
    return F.substr(F.lit(alphabet), v % len(alphabet) + 1, F.lit(1))


def surrogate(key: str, kind: Column, form: Column, attempt: Column) -> Column:
    """The canonical form of an entity's stand-in: same length and classes of characters.

    Cards keep their first digit and phones the leading two, IBANs their country, domains their last label; check digits of cards and
    IBANs are right; secrets stay hexadecimal, addresses stay addresses, names are made of syllables of their script with an ending of their
    gender (of Latin ones in a script that is not listed). Past ``SAME_LENGTH`` attempts they grow: e-mails in front, others but IP addresses at the end.
    """
    extra = F.greatest(attempt - SAME_LENGTH, F.lit(0))
    grown = F.when(kind == "email", F.concat(F.repeat(F.lit("a"), extra), form)).otherwise(F.concat(form, F.repeat(F.lit("0"), extra)))

    def chars(stream: Column) -> Column:
        keep = F.when(kind.isin("phone", "iban"), 2).when(kind == "card", 1).otherwise(0)
        tail = F.when(kind == "email", F.length(grown) - F.length(F.substring_index(grown, ".", -1))).otherwise(F.length(grown))
        one = lambda c, i, tail: (
            F.when((i < keep) | (i >= tail), c)
            .when((c >= "0") & (c <= "9"), (_byte(stream, i) % 10).cast("string"))
            .when((kind == "secret") & (c >= "a") & (c <= "f"), _pick("abcdef", _byte(stream, i)))
            .when((c >= "a") & (c <= "z"), _pick("abcdefghijklmnopqrstuvwxyz", _byte(stream, i)))
            .otherwise(c))
        plain = let(tail, lambda t: F.array_join(F.transform(F.split(grown, ""), lambda c, i: one(c, i, t)), ""))
        card = (kind == "card") & (F.length(form) >= 12) & F.regexp_like(form, F.lit("^[0-9]+$"))
        checked = let(plain, lambda p: F.when(card, let(F.substr(p, F.lit(1), F.length(p) - 1), lambda d: F.concat(d, _luhn(d)))).when(
            (kind == "iban") & F.regexp_like(p, F.lit("^[a-z]{2}[0-9]{2}[a-z0-9]+$")), _iban(p)).otherwise(p))
        return F.when(kind.isin("card", "iban"), checked).otherwise(plain)

    def address(stream: Column) -> Column:
        return F.concat_ws(".", *[(_byte(stream, F.lit(k)) % 223 + 1).cast("string") for k in range(4)])

    def name(stream: Column) -> Column:
        scripts = (("[а-яё]", "бвгдзклмнпрст", "аеио", "а", "н"), ("[α-ω]", "βγδζκλμνπρστ", "αεηιο", "α", "ς"), ("[a-z]", "bdfgklmnprstv", "aeiou", "a", "n"))
        made = F.lit(None).cast("string")
        for letters, hard, soft, her, his in reversed(scripts):  # Latin first, as what is left
            syllables = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.concat(_pick(hard, _byte(stream, i * 2)), _pick(soft, _byte(stream, i * 2 + 1)))), "")  # noqa: B023
            vowel = _pick(soft, _byte(stream, F.lit(7)))
            ending = F.when(F.startswith(form, F.lit("f ")), F.lit(her)).when(F.startswith(form, F.lit("m ")), F.concat(vowel, F.lit(his))).otherwise(vowel)
            more = F.transform(F.sequence(F.lit(0), extra), lambda i: F.when(i > 0, F.concat(_pick(hard, _byte(stream, i * 2 + 6)), _pick(soft, _byte(stream, i * 2 + 7)))).otherwise(""))  # noqa: B023
            word = F.concat(syllables, F.array_join(more, ""), _pick(hard, _byte(stream, F.lit(6))), ending)
            latin = scripts[-1] == (letters, hard, soft, her, his)
            made = word if latin else F.when(F.regexp_like(form, F.lit(f"^[fmn] .*{letters}")), word).otherwise(made)
        return F.concat(F.substring(form, 1, 2), made)

    return let(_stream(key, kind, form, attempt, F.length(form) + 32 + extra * 2), lambda s: F.when(kind == "ip", address(s)).when(kind == "name", name(s)).otherwise(chars(s)))


def dress(kind: Column, entity: Column, stand_in: Column) -> Column:
    """A stand-in (of a name: of one word) in the format of an occurrence: its separators, its upper and lower case; what makes it longer as it is."""
    cased = lambda c, s: F.when(F.regexp_like(c, F.lit(r"\p{Lu}")), F.upper(s)).otherwise(s)
    signs = lambda c: F.regexp_replace(c, r"[^\p{L}\p{N}]", "")

    def aligned(made: Column, front: Column) -> Column:
        inside = let(F.split(made, ""), lambda cs: F.array_join(F.transform(F.split(entity, ""), lambda c, i: cased(c, F.get(cs, i + front))), ""))
        return F.concat(F.substr(made, F.lit(1), front), inside, F.substr(made, F.length(entity) + front + 1))

    def spelled(made: Column) -> Column:
        counted = F.transform(F.sequence(F.lit(1), F.length(entity)), lambda i: F.length(signs(F.substr(entity, F.lit(1), i))))
        return let(signs(made), lambda bare: F.concat(let(counted, lambda n: F.array_join(F.transform(
            F.split(entity, ""), lambda c, i: F.when(~F.regexp_like(c, F.lit(r"[\p{L}\p{N}]")), c)
            .otherwise(cased(c, F.substr(bare, F.get(n, i), F.lit(1))))), "")), F.substr(bare, F.length(signs(entity)) + 1)))

    def named(made: Column) -> Column:
        word = F.substring(made, 3, 1 << 20)
        return F.when(F.regexp_like(entity, F.lit(r"\p{Ll}\P{L}*$")), F.initcap(word)).otherwise(F.upper(word))

    return let(stand_in, lambda s: F.when(kind == "ip", s).when(kind == "name", named(s)).when(
        kind == "email", let(F.length(s) - F.length(entity), lambda front: aligned(s, front))).when(kind == "secret", aligned(s, F.lit(0))).otherwise(spelled(s)))


def titled(text: Column) -> Column:
    """The entities of a text that a pattern tells alone, in order; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(ENTITY), F.lit(0))


def _gender(entity: Column) -> Column:
    """``f`` or ``m`` by the title of a name, else ``n``."""
    of = lambda g: F.regexp_like(entity, F.lit("^(?:" + "|".join(TITLES[g]) + r")\.? "))
    return F.when(of("f"), "f").when(of("m"), "m").otherwise("n")


def _words(name: Column) -> Column:
    """The words of a name without its title."""
    return F.split(F.regexp_replace(name, _TITLE, ""), " ")


def people(found: Column) -> Column:
    """(word, gender) of every word of the titled names among entities."""
    names = F.filter(found, lambda e: F.regexp_like(e, F.lit(f"{_TITLE}{_NAME}(?: {_NAME})?$")))
    return F.flatten(F.transform(names, lambda e: let(_gender(e), lambda g: F.transform(_words(e), lambda w: F.struct(w.alias("word"), g.alias("gender"))))))


def pattern(known: Column) -> Column:
    """What to replace in a text: entities, and the words of its people where they stand without a title."""
    words = F.array_join(F.array_distinct(F.transform(known, lambda k: k["word"])), "|")
    return F.when(F.size(known) > 0, F.concat(F.lit(ENTITY + r"|(?<![\p{L}\p{N}_])(?:"), words, F.lit(r")(?![\p{L}\p{N}_])"))).otherwise(F.lit(ENTITY))


def mentions(text: Column) -> Column:
    """(es, known, pattern) of a text: everything to be replaced, in order, and the people it titles."""
    body = F.coalesce(text, F.lit(""))
    return let(titled(text), lambda es: let(people(es), lambda known: let(pattern(known), lambda p: F.struct(
        F.when(F.size(known) > 0, F.regexp_extract_all(body, p, F.lit(0))).otherwise(es).alias("es"), known.alias("known"), p.alias("pattern")))))


def forms(kind: Column, entity: Column, known: Column) -> Column:
    """The canonical forms of a mention: of a name one for each word, with the gender of its title, else the first that the text tells of the word."""
    def of_word(w: Column, g: Column) -> Column:
        told = F.get(F.filter(known, lambda k: (k["word"] == w) & (k["gender"] != "n")), F.lit(0))["gender"]
        return F.concat(F.when(g != "n", g).otherwise(F.coalesce(told, F.lit("n"))), F.lit(" "), F.lower(w))

    named = let(_gender(entity), lambda g: F.transform(_words(entity), lambda w: of_word(w, g)))
    return F.when(kind == "name", named).otherwise(F.array(canonical(kind, entity)))


def _kind(entity: Column) -> Column:
    """The kind of a mention; what no pattern matches is a word of a name."""
    return F.coalesce(kind_of(entity), F.lit("name"))


def _found(docs: DataFrame, text: str, *cols: Column) -> DataFrame:
    """Rows (cols, kind, form), one for each form of each mention."""
    told = docs.select(*cols, mentions(docs[text]).alias("m")).select("*", F.explode(F.array_distinct("m.es")).alias("e"))
    kinds = told.withColumn("kind", _kind(F.col("e")))
    return kinds.withColumn("form", F.explode(forms(F.col("kind"), F.col("e"), F.col("m.known")))).drop("m", "e")


def distinct_entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows (kind, form): each entity of the table once. Counted in each task first, so a frequent one costs a row a task."""
    return _found(docs, text).distinct()


def stand_ins(found: DataFrame, key: str) -> DataFrame:
    """Rows (kind, form, stand_in, attempt): the distinct stand-in of each distinct entity; written.

    Of entities that draw the same one the least keeps it and the others draw again; so does one that draws a real entity of the table.
    """
    real = found.select("kind", F.col("form").alias("stand_in")).withColumn("real", F.lit(True))
    now = written(found.select("kind", "form", surrogate(key, F.col("kind"), F.col("form"), F.lit(0)).alias("stand_in"), F.lit(0).alias("attempt")), "stand-ins")
    for _ in range(ROUNDS):
        taken = now.groupBy("kind", "stand_in").agg(F.count("*").alias("n"), F.min(F.struct("attempt", "form")).alias("keeper")).join(real, ["kind", "stand_in"], "left")
        clash = written(taken.where((F.col("n") > 1) | F.col("real")).select("kind", "stand_in", F.when(F.col("real"), None).otherwise(F.col("keeper.form")).alias("keeper")), "clashes")
        if clash.isEmpty():
            return now
        marked = now.join(clash.withColumn("hit", F.lit(True)), ["kind", "stand_in"], "left").withColumn("lost", F.coalesce(F.col("hit"), F.lit(False)) & ~F.col("form").eqNullSafe(F.col("keeper")))
        attempt = F.col("attempt") + F.col("lost").cast("int")
        drawn = marked.select("kind", "form", F.when(F.col("lost"), surrogate(key, F.col("kind"), F.col("form"), attempt)).otherwise(F.col("stand_in")).alias("stand_in"), attempt.alias("attempt"))
        now = written(drawn, "stand-ins")
    raise ValueError("a kind of entity has too few possible stand-ins for its number of entities")


def pseudonymised(docs: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with every detected entity of ``text`` replaced; other columns, and texts without entities, as they are.

    ``count`` names an added column with the number of replacements. Null texts stay null. Entities that kept their first draw are
    replaced where they stand; only texts with one that drew again are joined to the table of those.
    """
    table = stand_ins(written(distinct_entities(docs, text), "entities"), key)
    again = table.where("attempt > 0").select("kind", "form", "stand_in")
    again = written(again, "redrawn")
    body = F.coalesce(docs[text], F.lit(""))
    redrawn = F.lit(None).cast("map<string,string>")
    out = docs
    if not again.isEmpty():
        row = free_name(docs, "redrawn_hash")
        keyed = _found(docs, text, F.xxhash64(docs[text]).alias(row)).join(small(again), ["kind", "form"]).distinct()
        maps = keyed.groupBy(row).agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws("|", "kind", "form"), "stand_in"))).alias(f"{row}_map"))
        maps = small(written(maps, "redrawn-texts"))
        out = docs.join(maps, F.xxhash64(docs[text]) == maps[row], "left")
        redrawn = F.col(f"{row}_map")

    def stand_in(k: Column, f: Column) -> Column:
        return F.coalesce(F.try_element_at(redrawn, F.concat_ws("|", k, f)), surrogate(key, k, f, F.lit(0)))

    def replaced(e: Column, known: Column) -> Column:
        def of_kind(k: Column) -> Column:
            found = forms(k, e, known)
            words = F.transform(F.arrays_zip(_words(e).alias("w"), found.alias("f")), lambda x: dress(k, x["w"], stand_in(k, x["f"])))
            named = F.concat(F.regexp_extract(e, _TITLE, 0), F.array_join(words, " "))
            return F.when(k == "name", named).otherwise(let(F.get(found, F.lit(0)), lambda f: dress(k, e, stand_in(k, f))))

        return let(_kind(e), of_kind)

    def rebuilt(m: Column) -> Column:
        between = F.split(body, m["pattern"], -1)
        new = F.transform(m["es"], lambda e: replaced(e, m["known"]))
        return F.array_join(F.transform(F.arrays_zip(between.alias("a"), new.alias("b")), lambda p: F.concat(p["a"], F.coalesce(p["b"], F.lit("")))), "")

    both = let(mentions(docs[text]), lambda m: F.struct(F.size(m["es"]).alias("n"), F.when(F.size(m["es"]) > 0, rebuilt(m)).alias("t")))
    name = free_name(docs, "replaced")
    made = out.select(*[docs[c] for c in docs.columns], both.alias(name))
    new = F.coalesce(F.col(f"{name}.t"), F.col(f"`{text}`")).alias(text)
    cols = [new if c == text else F.col(f"`{c}`") for c in docs.columns]
    return made.select(*cols, *([F.col(f"{name}.n").alias(count)] if count else []))
