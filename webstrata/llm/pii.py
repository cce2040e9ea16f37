"""Personal data replaced by keyed surrogates of the same kind and form, with Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize

#: The key of the test and bench queries. A job on real data passes its own and keeps it secret.
EXAMPLE_KEY = "example key"
#: Draws of an entity, as long as its surrogate collides, that keep its whole form. Later ones are out of a larger
#: space: surnames drawn for the one person and longer, eight more digits behind secrets and local parts, phone
#: numbers filled up to ten digits.
SAME_FORM = 32
#: Rounds of drawing anew. What still collides then has a form without room for so many entities (about as many as
#: there are numbers of its length), which is an error.
MOST_ROUNDS = 128

#: Titles that make what follows a person's name, by gender. Fixed values.
TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Signora", "госпожа", "Госпожа"),
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Signor", "господин", "Господин"),
    "n": ("Dr", "Prof"),
}
#: First names by gender and script, used as surrogates. Fixed values.
FIRST_NAMES = {
    ("f", "latin"): ("Alice", "Barbara", "Caroline", "Deborah", "Emily", "Hannah", "Jennifer", "Katherine", "Laura", "Maria",
                     "Nancy", "Olivia", "Patricia", "Rebecca", "Susan", "Victoria"),
    ("m", "latin"): ("Andrew", "Benjamin", "Charles", "Daniel", "Edward", "Frederick", "George", "Henry", "James", "John",
                     "Michael", "Nicholas", "Peter", "Robert", "Thomas", "William"),
    ("n", "latin"): ("Alex", "Chris", "Jamie", "Jordan", "Kim", "Morgan", "Robin", "Taylor"),
    ("f", "cyrillic"): ("Анна", "Елена", "Ирина", "Мария", "Наталья", "Ольга", "Светлана", "Татьяна"),
    ("m", "cyrillic"): ("Алексей", "Андрей", "Дмитрий", "Иван", "Михаил", "Николай", "Павел", "Сергей"),
    ("n", "cyrillic"): ("Саша", "Женя", "Валя", "Слава"),
    ("f", "greek"): ("Άννα", "Ελένη", "Ειρήνη", "Μαρία", "Κατερίνα", "Όλγα", "Σοφία", "Δήμητρα"),
    ("m", "greek"): ("Ανδρέας", "Νίκος", "Δημήτρης", "Γιάννης", "Μιχάλης", "Γιώργος", "Παύλος", "Κώστας"),
    ("n", "greek"): ("Φώτη", "Αργύρη", "Αλέξη", "Χάρη"),
}
#: Alphabets within which letters are exchanged.
ALPHABETS = (
    "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
    "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
    "äöüàâçèéêëîïôùûñáíóú", "ÄÖÜÀÂÇÈÉÊËÎÏÔÙÛÑÁÍÓÚ",
)
_HEX, _DIGITS = "abcdef", "0123456789"
#: Alphabets that replace letters and digits not listed above, by what matches them; the first counts, and the last
#: two are for scripts that none is given for. Small letters stay small where the script has cases. Fixed values.
SCRIPTS = {
    r"[\p{IsCyrillic}&&\p{Lu}]": ALPHABETS[3], r"[\p{IsCyrillic}&&\p{L}]": ALPHABETS[2],
    r"[\p{IsGreek}&&\p{Lu}]": ALPHABETS[5], r"[\p{IsGreek}&&\p{L}]": ALPHABETS[4],
    r"[\p{IsArmenian}&&\p{Lu}]": "ԱԲԳԴԵԶԷԸԹԺԻԼԽԾԿՀՁՂՃՄՅՆՇՈՉՊՋՌՍՎՏՐՑՓՔՕՖ",
    r"[\p{IsArmenian}&&\p{L}]": "աբգդեզէըթժիլխծկհձղճմյնշոչպջռսվտրցփքօֆ",
    r"[\p{IsHebrew}&&\p{L}]": "אבגדהוזחטיכלמנסעפצקרשת", r"[\p{IsArabic}&&\p{L}]": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
    r"[\p{IsDevanagari}&&\p{L}]": "अआइईउऊएऐओऔकखगघचछजझटठडढणतथदधनपफबभमयरलवशषसह",
    r"[\p{IsBengali}&&\p{L}]": "অআইঈউঊএঐওঔকখগঘচছজঝটঠডঢণতথদধনপফবভমযরলশষসহ",
    r"[\p{IsThai}&&\p{L}]": "กขคงจฉชซญณดตถทธนบปผฝพฟภมยรลวศษสหอฮ", r"[\p{IsGeorgian}&&\p{L}]": "აბგდევზთიკლმნოპჟრსტუფქღყშჩცძწჭხჯჰ",
    r"[\p{IsHiragana}&&\p{L}]": "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほまみむめもやゆよらりるれろわ",
    r"[\p{IsKatakana}&&\p{L}]": "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワ",
    r"[\p{IsHangul}&&\p{L}]": "가나다라마바사아자차카타파하고노도로모보소오조초코토포호구누두루무부수우주추쿠투푸후",
    r"[\p{IsHan}&&\p{L}]": "一丁七万三上下不中主久九二五人今代以会作使來信元光入八公六分力北十千南原口古向同名国土在地城大天太夫女子安家小山工市平年心文方日明月木本村東林正水永江海清火王田白石立竹米花草見言谷車金長門青面音風高",
    r"\p{N}": _DIGITS, r"\p{Lu}": ALPHABETS[1], r"\p{L}": ALPHABETS[0],
}
#: What replaces the other signs of a secret: those of ASCII if it has hardly anything else, and all that are not.
_MARKS = "!#$%&*+-?@^_~"
_OTHERS = {r"[^\x00-\x7F]": ALPHABETS[0]}

_SIGN, _NO_SIGN, _CYRILLIC, _GREEK = r"[\p{L}\p{N}]", r"[^\p{L}\p{N}]", r"\p{IsCyrillic}", r"\p{IsGreek}"
_ALL_TITLES = "|".join(t for line in TITLES.values() for t in line)
#: What is looked for, by kind; the first that matches at a place counts. Repeats never give back, or are bounded.
PATTERNS = {
    "email": rf"(?<![\p{{L}}\p{{N}}._%+\-])[\p{{L}}\p{{N}}][\p{{L}}\p{{N}}._%+\-]*+@[\p{{L}}\p{{N}}\-]++(?:\.[\p{{L}}\p{{N}}\-]++)++",
    "secret": rf"(?<!{_SIGN})(?:[Pp]assword|[Pp]asswd|[Pp]wd|[Tt]oken|[Ss]ecret|[Aa]pi[_\-]?[Kk]ey) {{0,3}}= {{0,3}}[\"']?[^\s\"'=]{{4,}}+",
    "key": rf"(?<!{_SIGN})(?:AKIA|ASIA)[A-Z0-9]{{16}}(?!{_SIGN})",
    "iban": rf"(?<!{_SIGN})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{3,7}}(?: ?[A-Z0-9]{{1,3}})?(?!{_SIGN})",
    "ip": r"(?<![\p{L}\p{N}.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![\p{L}\p{N}\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}\-])",
    "card": rf"(?<![\p{{L}}\p{{N}}+])(?:[0-9]{{4}}[ \-][0-9]{{4}}[ \-][0-9]{{4}}[ \-][0-9]{{1,7}}|[0-9]{{13,19}})(?!{_SIGN})",
    "phone": r"(?<![\p{L}\p{N}])(?:\+[0-9]{1,3}[ .\-]?)?(?:\([0-9]{2,4}\) ?|[0-9]{3}[.\-])[0-9]{3,4}[ .\-][0-9]{4}(?![0-9])"
             r"|\+[0-9]{1,3}(?:[ .\-]?[0-9]{2,4}){2,4}(?![0-9])",
    "name": rf"(?<!\p{{L}})(?:{_ALL_TITLES})\.?(?: \p{{Lu}}\p{{Ll}}++){{1,3}}+",
}
# Nothing begins inside a word, which is settled first.
ANY = rf"(?<!{_SIGN})(?:{'|'.join(f'(?:{p})' for p in PATTERNS.values())})"
#: A text that contains none of these has no entity; plain searches are much faster than ``ANY``. In the order of
#: ``PATTERNS``: e-mail and secret, key, name; three digits (SSN, card, most phones), IP, phone with "+", account.
_MAYBE = ("@", "=", "AKIA", "ASIA", *(t for line in TITLES.values() for t in line if t[:-1] not in line))
_MAYBE_DIGITS = r"[0-9]{3}|[0-9]\.[0-9]|\+[0-9]|[A-Z]{2}[0-9]{2}"


def found_in(text: Column) -> Column:
    """All entities of a text, in order; none for null."""
    maybe = text.rlike(_MAYBE_DIGITS)
    for sign in _MAYBE:
        maybe = maybe | text.contains(sign)
    return F.when(maybe, F.regexp_extract_all(text, F.lit(ANY), 0)).otherwise(F.array().cast("array<string>"))


def _quoted(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _kind() -> str:
    """The kind of a string ``entity`` that ``ANY`` matched: the first whose pattern matches all of it."""
    cases = " ".join(f"WHEN entity RLIKE {_quoted(f'^(?:{pattern})$')} THEN '{kind}'" for kind, pattern in PATTERNS.items())
    return f"CASE {cases} ELSE 'phone' END"


def _normal(entity: str) -> str:
    """What is equal for all ways to write one entity: the same phone number in other punctuation is the same."""
    digits = f"regexp_replace({entity}, '[^0-9]', '')"
    title = _quoted(rf"^(?:{_ALL_TITLES})\.? ")
    return f"""CASE kind
        WHEN 'phone' THEN right({digits}, 10)
        WHEN 'card' THEN {digits}
        WHEN 'ssn' THEN {digits}
        WHEN 'iban' THEN replace(upper({entity}), ' ', '')
        WHEN 'email' THEN lower({entity})
        WHEN 'name' THEN lower(regexp_replace({entity}, {title}, ''))
        WHEN 'secret' THEN regexp_replace({entity}, {_quoted("^[^=]*= *[\"']?")}, '')
        ELSE {entity} END"""


def _stream(seed: str, length: str) -> str:
    """Hex digits that depend on the seed alone, two for each of so many letters and digits."""
    return f"array_join(transform(sequence(0, int({length} / 32)), b -> sha2(concat_ws('|', {seed}, b), 256)), '')"


def _number(stream: str, at: str, width: int = 2) -> str:
    """A number out of the stream, by its position."""
    return f"int(conv(substring({stream}, ({at}) * {width} + 1, {width}), 16, 10))"


def _behind(text: str) -> str:
    """Letters and digits that come after the i-th sign (from 0); equal for all ways to punctuate."""
    return f"length(regexp_replace(substring({text}, i + 2), {_quoted(_NO_SIGN)}, ''))"


def _exchanged(text: str, stream: str, alphabets: tuple[str, ...], others: dict[str, str] = {}, at: str | None = None) -> str:
    """Every letter and digit exchanged within its alphabet or, if none lists it, for one of its script; case and
    punctuation kept. ``others`` are patterns of more signs to exchange; ``at`` is the place in the stream."""
    listed = f"array({', '.join(map(_quoted, alphabets))})"
    cases = " ".join(f"WHEN c RLIKE {_quoted(p)} THEN {_quoted(a)}" for p, a in {**SCRIPTS, **others}.items())
    own = f"coalesce(get(filter({listed}, a -> instr(a, c) > 0), 0), CASE {cases} END)"
    drawn = f"substring(a, {_number(stream, at or _behind(text))} % length(a) + 1, 1)"
    one = f"get(transform(array({own}), a -> coalesce({drawn}, c)), 0)"
    return f"array_join(transform(split({text}, ''), (c, i) -> {one}), '')"


def _luhn(digits: str) -> str:
    """Check sum of a card number; 0 modulo 10 if it is valid."""
    worth = "CASE WHEN i % 2 = 0 THEN int(c) WHEN int(c) > 4 THEN 2 * int(c) - 9 ELSE 2 * int(c) END"
    return f"aggregate(transform(split(reverse({digits}), ''), (c, i) -> {worth}), 0, (s, x) -> s + x)"


def _names(gender: str, script: str) -> str:
    return f"array({', '.join(map(_quoted, FIRST_NAMES[gender, script]))})"


def _gender() -> str:
    """Of a name, by its title."""
    told = {g: _quoted(rf"^(?:{'|'.join(TITLES[g])})\.? ") for g in ("f", "m")}
    return f"CASE {' '.join(f"WHEN entity RLIKE {t} THEN '{g}'" for g, t in told.items())} ELSE 'n' END"


def _person() -> str:
    """Title kept, a first name of the same gender and script, and a drawn surname that follows the surname."""
    # A full name that is drawn again gets another first name at first, so that the surname stays that of relatives;
    # there are not enough first names for more than some, so the surname is that of the person alone in the end.
    wide = f"attempt >= {SAME_FORM}"
    turn = f"CASE WHEN size(names) > 1 AND i > 0 AND NOT {wide} THEN int(attempt / 8) ELSE attempt END"
    of = f"CASE WHEN {wide} THEN concat_ws(' ', norm, i) ELSE lower(n) END"
    seeds = f"transform(names, (n, i) -> struct(n AS name, sha2(concat_ws('|', secret, 'name', {of}, {turn}), 256) AS s))"
    first = " ".join(
        f"WHEN gender = '{g}' AND script = '{script}' THEN "
        f"element_at({_names(g, script)}, {_number('x.s', '0')} % {len(FIRST_NAMES[g, script])} + 1)"
        for g, script in FIRST_NAMES
    )

    def surname(opens: str, vowels: str) -> str:
        pair = (
            f"substring('{opens}', {_number('x.s', '2 * k + 1')} % {len(opens)} + 1, 1) || "
            f"substring('{vowels}', {_number('x.s', '2 * k + 2')} % {len(vowels)} + 1, 1)"
        )
        return f"initcap(array_join(transform(sequence(0, CASE WHEN {wide} THEN 4 ELSE 3 END), k -> {pair}), ''))"

    last = f"""CASE script WHEN 'cyrillic' THEN {surname('бвгдклмнпрст', 'аеиоу')}
        WHEN 'greek' THEN {surname('βγδζκλμνπρτφ', 'αεηιου')} ELSE {surname('bdfgklmnprstvw', 'aeiou')} END"""
    each = f"CASE WHEN i = 0 AND size(names) > 1 THEN CASE {first} END ELSE {last} END"
    return f"title || array_join(transform({seeds}, (x, i) -> {each}), ' ')"


def with_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """Add ``new``, a replacement of the same kind and form, to rows of ``kind``, ``entity``, ``norm``, ``attempt``.

    It depends on the key, the entity and ``attempt`` alone; from ``SAME_FORM`` on it may be longer. Steps are projections of their own, so that what several
    kinds need is computed once.

    Addresses: local part by the whole address, domain by the domain alone (colleagues stay colleagues), last label
    kept. Letters: replaced by some of their script (``SCRIPTS``), by Latin ones if it is not listed; names are Latin,
    Cyrillic or Greek, and Latin for all other scripts. Phone numbers: country code and form kept, no area or exchange code from 0 or 1. Cards: first digit and
    grouping kept, valid exactly if the original was. Keys and account numbers: prefix kept. Secrets: label kept, and
    punctuation if there are four letters and digits at least."""
    columns = entities.columns
    every = (*ALPHABETS, _DIGITS)
    by_domain = _stream("secret, 'domain', domain", "length(domain)")
    title = _quoted(rf"^(?:{_ALL_TITLES})\.? ")
    top = "length(substring_index(domain, '.', -1))"
    phone = f"""array_join(transform(split(entity, ''), (c, i) -> CASE
        WHEN c NOT BETWEEN '0' AND '9' OR {_behind('entity')} > 9 THEN c
        WHEN {_behind('entity')} IN (6, 9) THEN string({_number('stream', _behind('entity'))} % 8 + 2)
        ELSE string({_number('stream', _behind('entity'))} % 10) END), '')"""
    octets = " || '.' || ".join(f"({_number('stream', str(j), 4)} % 254 + 1)" for j in range(4))
    card = f"""array_join(transform(split(entity, ''), (c, i) -> CASE WHEN c BETWEEN '0' AND '9'
        THEN substring(digits, length(digits) - {_behind('entity')}, 1) ELSE c END), '')"""
    more = "lpad(right(conv(left(sha2(concat_ws('|', secret, kind, norm, attempt, 'more'), 256), 12), 16, 10), 8), 8, '0')"
    steps = entities.withColumn("secret", F.lit(key))
    steps = steps.selectExpr(
        *columns,
        "secret",
        f"{_stream('secret, kind, norm, attempt', 'length(norm)')} AS stream",
        f"CASE WHEN attempt < {SAME_FORM} THEN '' ELSE {more} END AS more",
        "CASE WHEN kind = 'email' THEN lower(substring_index(entity, '@', -1)) END AS domain",
        f"CASE WHEN kind = 'name' THEN regexp_extract(entity, {title}, 0) ELSE '' END AS title",
        f"CASE WHEN kind = 'name' THEN {_gender()} END AS gender",
        rf"CASE WHEN norm RLIKE {_quoted(_CYRILLIC)} THEN 'cyrillic' WHEN norm RLIKE {_quoted(_GREEK)} THEN 'greek' ELSE 'latin' END AS script",
    )
    steps = steps.selectExpr(
        "*",
        f"CASE WHEN kind = 'email' THEN {by_domain} END AS domain_stream",
        "CASE WHEN kind = 'name' THEN split(substring(entity, length(title) + 1), ' ') END AS names",
        f"CASE WHEN kind = 'card' THEN left(norm, 1) || substring({_exchanged('norm', 'stream', (_DIGITS,))}, 2, length(norm) - 2) END AS body",
    )
    check = f"pmod({_luhn('norm')} - {_luhn('body || 0')}, 10)"
    steps = steps.selectExpr("*", f"CASE WHEN kind = 'card' THEN body || {check} END AS digits")
    email = f"""{_exchanged("substring_index(entity, '@', 1)", 'stream', every)} || more || '@' ||
        {_exchanged(f"left(substring_index(entity, '@', -1), length(domain) - {top})", 'domain_stream', every)} ||
        substring_index(entity, '.', -1)"""
    value = f"""CASE WHEN norm RLIKE '^[0-9a-f]+$' THEN {_exchanged('norm', 'stream', (_HEX, _DIGITS))}
        WHEN length(regexp_replace(norm, {_quoted(_NO_SIGN)}, '')) < 4
        THEN {_exchanged('norm', 'stream', (*every, _MARKS), _OTHERS | {'.': _MARKS}, 'i')}
        ELSE {_exchanged('norm', 'stream', every, _OTHERS)} END"""
    new = f"""CASE kind
        WHEN 'email' THEN {email}
        WHEN 'phone' THEN {phone} || left(more, greatest(0, 10 - length(norm)))
        WHEN 'ip' THEN {octets}
        WHEN 'card' THEN {card}
        WHEN 'secret' THEN left(entity, length(entity) - length(norm)) || {value} || more
        WHEN 'name' THEN {_person()}
        WHEN 'key' THEN left(entity, 4) || {_exchanged('substring(entity, 5)', 'stream', every)}
        WHEN 'iban' THEN left(entity, 2) || {_exchanged('substring(entity, 3)', 'stream', every)}
        ELSE {_exchanged('entity', 'stream', every)} END"""
    return steps.selectExpr(*columns, f"{new} AS new")


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """(kind, norm, attempt) for every entity of ``entities`` (``kind``, ``norm``), so that no two share a surrogate.

    A surrogate that two entities of a kind would share, or that is itself an entity of the texts, is drawn again
    for all but the smallest. Names are looked at with a title of each gender, as each has first names of its own.
    Raises ``ValueError`` if some still collide after ``MOST_ROUNDS``."""
    known = materialize(entities.distinct(), "entities")
    taken = known.select("kind", F.col("norm").alias("drawn"))
    state = known.withColumn("attempt", F.lit(0))
    titled = ", ".join(f"concat({_quoted(line[0])}, ' ', norm)" for line in TITLES.values())
    ways = f"posexplode(CASE WHEN kind = 'name' THEN array({titled}) ELSE array(norm) END) AS (way, entity)"
    for _ in range(MOST_ROUNDS):
        drawn = with_surrogates(state.selectExpr("*", ways), key)
        drawn = materialize(drawn.selectExpr("kind", "norm", "attempt", "way", f"{_normal('new')} AS drawn"), "surrogates")
        shared = drawn.groupBy("kind", "drawn").agg(F.min("norm").alias("first"), F.max("norm").alias("last")).where("first != last")
        again = (
            drawn.join(shared, ["kind", "drawn"]).where("norm != first").select("kind", "norm")
            .unionByName(drawn.join(taken, ["kind", "drawn"], "left_semi").select("kind", "norm"))
            .distinct()
        )
        again = materialize(again.withColumn("again", F.lit(1)), "collisions")
        if again.isEmpty():
            return state
        state = drawn.where("way = 0").select("kind", "norm", "attempt").join(again, ["kind", "norm"], "left")
        state = state.selectExpr("kind", "norm", "attempt + coalesce(again, 0) AS attempt")
    left = {r.kind: r["count"] for r in again.groupBy("kind").count().collect()}
    raise ValueError(f"entities without a surrogate of their own after {MOST_ROUNDS} rounds, by kind: {left}")


def pseudonymize(docs: DataFrame, key: str, text: str = "text", count: str | None = "n_entities") -> DataFrame:
    """``docs`` with every entity of the column ``text`` replaced; ``count`` names a column for how many there were.

    The same entity gets the same surrogate wherever and however it is written, different ones get different ones, and
    the rest of the text stays as it is. Documents without entities are only mapped. The others are written once; their
    entities are drawn and checked once each, whatever number of documents share them, and joined back (an entity of a
    third of all documents is a skewed join key, which adaptive execution splits).

    Null texts stay null and empty ones empty; repeated rows give repeated rows; other columns are kept, whatever
    their names (a column named like ``count`` is replaced)."""
    names = [c for c in docs.columns if c != count]
    columns = [F.col(f"`{c}`") for c in names]
    plain = docs.select(F.struct(*columns).alias("doc"), found_in(F.col(text).cast("string")).alias("entities"))
    without = plain.where(F.size("entities") == 0).select("doc", F.lit(0).alias("n"))
    holders = materialize(plain.where(F.size("entities") > 0).withColumn("row", F.monotonically_increasing_id()), "holders")
    each = holders.select("row", F.posexplode("entities").alias("place", "entity"))
    each = each.selectExpr("*", f"{_kind()} AS kind").selectExpr("*", f"{_normal('entity')} AS norm")
    each = materialize(each, "mentions")
    table = surrogate_table(each.select("kind", "norm"), key)
    drawn = with_surrogates(each.join(table, ["kind", "norm"]), key).select("row", "place", "new")
    by_row = drawn.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "new"))).alias("new"))
    between = F.split(F.col(f"doc.`{text}`").cast("string"), ANY, -1)
    news = F.concat(F.col("new.new"), F.array(F.lit("")))
    changed = F.array_join(F.zip_with(between, news, lambda a, b: F.concat(a, b)), "")
    replaced = [changed.alias(text) if c == text else F.col(f"doc.`{c}`").alias(c) for c in names]
    with_some = holders.join(by_row, "row").select(F.struct(*replaced).alias("doc"), F.size("entities").alias("n"))
    # columns are unpacked last, so that no name of the caller's can be taken for one of these
    unpacked = [F.col(f"doc.`{c}`").alias(c) for c in names] + ([F.col("n").alias(count)] if count else [])
    return without.unionByName(with_some).select(*unpacked)
