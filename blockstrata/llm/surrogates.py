"""Personal data replaced by keyed surrogates of the same type, in DataFrame functions only."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage

MEN = "Mr|Mister|Sir|Herr|Señor|Sr|Monsieur|Don|Г-н|Господин"
WOMEN = "Mrs|Ms|Miss|Madam|Frau|Señora|Señorita|Sra|Madame|Mme|Doña|Г-жа|Госпожа"
EITHER = "Dr|Prof|Professor|Доктор"
NAME = r"\p{Lu}[\p{L}'’-]+"
#: An entity begins where no letter or digit goes before.
EDGE = r"(?<![\p{L}\d])"
LABEL = r"[\p{L}\p{M}\p{N}-]++"
#: Patterns of each kind after an edge, in the order in which they are tried. No group repeats without a
#: bound unless possessively, for Java calls itself once per turn; an address begins where no sign of one goes before.
KINDS = {
    "email": rf"(?<![\p{{L}}\p{{M}}\p{{N}}._%+-])[\p{{L}}\p{{M}}\p{{N}}._%+-]++@{LABEL}(?:(?:\.{LABEL}){{127,}}+(?<=\.\p{{L}}{{2,63}})|(?:\.{LABEL}){{0,126}}\.\p{{L}}{{2,}})",
    "key": r"(?:AKIA|ASIA)[A-Z0-9]{12,20}(?![A-Za-z0-9])|(?:ghp_|sk-)[A-Za-z0-9]{16,}",
    "secret": r"(?i:(?:password|passwd|pwd|token|secret|api_?key)\s{0,3}[=:]\s{0,3}[\"']?)[A-Za-z0-9_+/=-]{8,}",
    "ip": r"(?<!\.)(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\d]|\.\d)",
    "phone": r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,5}){1,4}(?!\d)|\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<!-)\d{3}-\d{3}-\d{4}(?![\d-])",
    "ssn": r"(?<!-)\d{3}-\d{2}-\d{4}(?![\d-])",
    "iban": r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\d])",
    "card": r"(?<!-)(?:\d{4}[ -]){3}\d{1,7}(?![\d-])|(?<!-)\d{13,19}(?![\p{L}\d-])",
    "name": rf"(?=\p{{Lu}})(?:{MEN}|{WOMEN}|{EITHER})\.? {NAME}(?: {NAME})?",
}
DIGIT_KINDS = ("phone", "ssn", "card")
SECRET_HEAD = r"(?i)^((?:password|passwd|pwd|token|secret|api_?key)\s{0,3}[=:]\s{0,3}[\"']?|AKIA|ASIA|ghp_|sk-)"


def _any():
    return EDGE + "(?:" + "|".join(KINDS.values()) + ")"


#: What a text with an entity has at least: a digit, an @, the head of a secret or key, or a form of address. Cheap to look for.
SIGN = rf"[\d@]|[=:](?<=(?i:password|passwd|pwd|token|secret|api_?key)\s{{0,3}}[=:])|A[KS]IA|_(?<=ghp_)|-(?<=sk-)|(?=[A-ZГД])(?<!\p{{L}})(?:{MEN}|{WOMEN}|{EITHER})\.? \p{{Lu}}"


def _names(found):
    """Pattern of the names among a text's entities, as written, in capitals and
    with a capital first; null if there are none."""
    full = F.filter(found, lambda m: F.regexp_like(m, _lit(f"^(?:{KINDS['name']})$")))
    words = F.flatten(F.transform(full, lambda m: F.filter(F.split(m, r"\s+"), lambda w, i: i > 0)))
    words = F.flatten(F.transform(words, lambda w: F.array(w, F.initcap(w), F.upper(w))))
    # Longer names come before their beginnings.
    return F.when(F.size(words) > 0, F.array_join(F.sort_array(F.array_distinct(words), asc=False), "|"))


def _any_or(names):
    return F.concat(F.lit(EDGE + "(?:" + "|".join(KINDS.values()) + "|(?:"), names, F.lit(r")(?![\p{L}\d]))"))


def _lit(pattern):
    return F.lit(pattern)


def _kind(mention):
    out = F.lit("name")
    for kind, pattern in reversed(list(KINDS.items())[:-1]):
        # The mention stands alone here, so looks around it hold at its edges.
        out = F.when(F.regexp_like(mention, _lit(f"^(?:{pattern})$")), kind).otherwise(out)
    return out


def mentions(docs):
    """row, place, part, piece, type, kind, canonical of each part of each entity.

    ``docs``: row, found (the entities of a text in order).

    Names give a part per word, so that a name alone and within a longer name
    is the same entity, addresses their mailbox and their domain; what stays as it is has a null kind. A name without a
    form of address has the kind that it has elsewhere in its row.
    """
    found = docs.select("row", F.posexplode("found").alias("place", "mention"))
    found = found.withColumn("type", _kind(F.col("mention")))
    head = F.regexp_extract("mention", SECRET_HEAD, 1)
    hidden = F.col("type").isin("key", "secret")
    parts = (F.when(F.col("type") == "name", F.regexp_extract_all("mention", _lit(r"\S+|\s+"), F.lit(0)))
             .when(F.col("type") == "email", F.array(F.substring_index("mention", "@", 1), F.lit("@"), F.substring_index("mention", "@", -1)))
             .when(hidden, F.array(head, F.substring("mention", F.char_length(head) + 1, F.char_length("mention"))))
             .otherwise(F.array("mention")))
    gender = (F.when(F.regexp_like("mention", _lit(rf"^(?:{WOMEN})\b")), "given_f")
              .when(F.regexp_like("mention", _lit(rf"^(?:{MEN})\b")), "given_m").otherwise("given"))
    found = found.select("row", "place", "type", gender.alias("gender"), F.size(parts).alias("n"), F.posexplode(parts).alias("part", "piece"))
    part, n = F.col("part"), F.col("n")
    kind = (F.when((F.col("type") == "name") & (n == 1), "bare")
            .when((F.col("type") == "name") & ((part == 0) | (part % 2 == 1)), F.lit(None))
            .when(F.col("type") == "name", F.when(part == n - 1, "surname").otherwise(F.col("gender")))
            .when(F.col("type").isin("key", "secret") & (part == 0), F.lit(None))
            .when(F.col("type") == "email", F.when(part == 0, "mailbox").when(part == 2, "domain"))
            .otherwise(F.col("type")))
    found = found.withColumn("kind", kind)
    piece = F.col("piece")
    canonical = (F.when(F.col("kind").isin(*DIGIT_KINDS), F.regexp_replace(piece, r"\D", ""))
                 .when(F.col("kind") == "iban", F.regexp_replace(piece, " ", ""))
                 .when(F.col("kind").isin("mailbox", "domain", "surname", "given", "given_f", "given_m", "bare"), F.lower(piece)).otherwise(piece))
    found = found.withColumn("canonical", canonical)
    # By their order, a surname goes before a given name, and a known gender before none.
    named = F.max(F.when(F.col("kind").startswith("given") | (F.col("kind") == "surname"), F.col("kind"))).over(W.partitionBy("row", "canonical"))
    found = found.withColumn("kind", F.when(F.col("kind") == "bare", F.coalesce(named, F.lit("surname"))).otherwise(F.col("kind")))
    return found.select("row", "place", "part", "piece", "type", "kind", "canonical")


def _draw(i, n, salt="root"):
    return F.pmod(F.xxhash64(salt, i), F.lit(n))


def _pick(letters, i, salt="root"):
    return F.substring(F.lit(letters), (_draw(i, len(letters), salt) + 1).cast("int"), F.lit(1))


#: Letters that stand for those of a script without small letters, and small and large ones of others.
LETTERS = {
    "IsHan": "安白北本成大东方高光国海和河华家江金林明南平青山石水天文西新雪阳永玉园云中竹子",
    "IsHiragana": "あいうえおかきくけこさしすせそたちつてとなにぬねのまみむめもやゆよらりるれろ",
    "IsKatakana": "アイウエオカキクケコサシスセソタチツテトナニヌネノマミムメモヤユヨラリルレロ",
    "IsHangul": "가나다라마바사아자차카타파하고노도로모보소오조초코토포호구누두루무부수우주",
    "IsArabic": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
    "IsHebrew": "אבגדהוזחטיכלמנסעפצקרשת",
    "IsDevanagari": "कखगघचछजझटठडढतथदधनपफबभमयरलवशषसह",
    "IsThai": "กขคฆงจฉชซญฎฏฐดตถทธนบปผฝพฟภมยรลวศษสหอ",
}


def _fill(text, salt="root", base=0):
    """Every letter and digit of a text replaced by one of its own kind and script."""
    def one(c, i):
        at = i + 1 + base
        out = (F.when(F.regexp_like(c, _lit(r"^\d$")), _pick("0123456789", at, salt))
               .when(F.regexp_like(c, _lit("^[a-z]$")), _pick("abcdefghijklmnopqrstuvwxyz", at, salt))
               .when(F.regexp_like(c, _lit("^[A-Z]$")), _pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", at, salt))
               .when(F.regexp_like(c, _lit(r"^[\u0430-\u044f]$")), _pick("абвгдежзиклмнопрстуфхцчшэюя", at, salt))
               .when(F.regexp_like(c, _lit(r"^[\u0410-\u042f]$")), _pick("АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ", at, salt))
               .when(F.regexp_like(c, _lit(r"^\p{Ll}$")), _pick("aeioubcdfglmnprst", at, salt))
               .when(F.regexp_like(c, _lit(r"^\p{Lu}$")), _pick("AEIOUBCDFGLMNPRST", at, salt)))
        for script, letters in LETTERS.items():
            out = out.when(F.regexp_like(c, _lit(rf"^(?=\p{{L}})\p{{{script}}}$")), _pick(letters, at, salt))
        return (out.when(F.regexp_like(c, _lit(r"^\p{L}$")), _pick("aeioubcdfglmnprst", at, salt))
                .when(F.regexp_like(c, _lit(r"^\p{N}$")), _pick("0123456789", at, salt)).otherwise(c))
    return F.array_join(F.transform(F.regexp_extract_all(text, _lit("(?s)."), F.lit(0)), one), "")


def _more(longer, letters="abcdefghijklmnopqrstuvwxyz0123456789"):
    """Further letters for what still collides."""
    return F.when(longer > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(longer, F.lit(1))), lambda i: _pick(letters, i + 5000)), "")).otherwise("")


def _hex(text):
    return F.array_join(F.transform(F.sequence(F.lit(1), F.char_length(text)), lambda i: _pick("0123456789abcdef", i)), "")


def _luhn(digits):
    """Digits whose last one makes the whole pass the check of card numbers."""
    n = F.char_length(digits)
    value = F.aggregate(F.sequence(F.lit(1), n - 1), F.lit(0), lambda s, i: s + F.element_at(
        F.when(F.pmod(n - i, F.lit(2)) == 1, F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)))).otherwise(F.array(*map(F.lit, range(10)))),
        F.substring(digits, i, F.lit(1)).cast("int") + 1))
    return F.concat(F.substring(digits, F.lit(1), n - 1), F.pmod(-value, F.lit(10)).cast("string"))


def _name(text, longer, end):
    """A made-up name in the script of the old one, longer after collisions."""
    def word(onset, vowel, closing):
        syllable = lambda i: F.concat(_pick(onset, i * 2), _pick(vowel, i * 2 + 1))
        return F.concat(F.array_join(F.transform(F.sequence(F.lit(1), F.lit(2) + longer), syllable), ""), _pick(closing, F.lit(0)) if closing else F.lit(""))
    cyrillic, greek = F.regexp_like(text, _lit(r"\p{IsCyrillic}")), F.regexp_like(text, _lit(r"\p{IsGreek}"))
    return F.when(cyrillic, word("бвгдклмнпрст", "аеиоу", end[1])).when(greek, word("βγδκλμνπρτ", "αειο", "νρ")).otherwise(word("bdfgklmnprstv", "aeiou", end[0]))


def _surrogate():
    c, kind, longer = F.col("canonical"), F.col("kind"), F.floor(F.col("attempt") / 3).cast("int")
    octet = lambda i, low, n: (_draw(F.lit(i), n) + low).cast("string")
    dot = F.char_length(c) - F.char_length(F.substring_index(c, ".", -1))
    # Before the dot of the last label.
    domain = F.concat(_fill(F.substring(c, F.lit(1), F.greatest(dot - 1, F.lit(0)))), _more(longer), F.lit("."), F.substring_index(c, ".", -1))
    card = F.concat(F.substring(c, 1, 1), _fill(F.substring(c, F.lit(2), F.char_length(c))))
    phone = F.concat(F.substring(c, 1, 1), _pick("23456789", F.lit(900)), _fill(F.substring(c, F.lit(3), F.char_length(c))))
    return (F.when(kind == "domain", domain)
            .when(kind == "mailbox", F.concat(_fill(c), _more(longer)))
            .when(kind == "ip", F.concat_ws(".", octet(1, 1, 223), octet(2, 0, 256), octet(3, 0, 256), octet(4, 1, 254)))
            .when(kind == "phone", phone)
            .when((kind == "card") & (_luhn(c) == c), _luhn(card))
            .when(kind == "card", card)
            .when(kind == "iban", F.concat(F.substring(c, 1, 2), _fill(F.substring(c, F.lit(3), F.char_length(c)))))
            .when(kind.isin("secret", "key") & F.regexp_like(c, _lit("^[0-9a-f]+$")), F.concat(_hex(c), _more(longer, "0123456789abcdef")))
            .when(kind.isin("secret", "key"), F.concat(_fill(c), _more(longer)))
            .when(kind == "given_f", F.concat(_name(c, longer, ("lnrs", "лнрс")), F.when(F.regexp_like(c, _lit(r"\p{IsCyrillic}")), "а").when(F.regexp_like(c, _lit(r"\p{IsGreek}")), "α").otherwise("a")))
            .when(kind == "given_m", _name(c, longer, ("nrsdk", "нрдк")))
            .when(kind.isin("given", "surname"), _name(c, longer, ("nrst", "внск")))
            .otherwise(_fill(c)))


def surrogate_table(entities, key):
    """kind, canonical, surrogate: distinct entities with distinct surrogates.

    A surrogate that another entity of its kind has too, or that is itself an
    entity of the data, is drawn anew for all but the first of them, until
    none is left. After every third draw names, mailboxes, domains, secrets and
    keys grow by a syllable or letter.
    """
    table = entities.select("kind", "canonical").distinct().withColumn("attempt", F.lit(0))
    names = F.when(F.col("kind").startswith("given") | (F.col("kind") == "surname"), "name").otherwise(F.col("kind"))
    while True:
        root = F.sha2(F.concat_ws("\x1f", F.lit(key), "kind", "canonical", "attempt"), 256)
        table = cut_lineage(table.withColumn("root", root).withColumn("surrogate", _surrogate())
                            .select("kind", "canonical", "attempt", names.alias("space"), "surrogate"))
        first = table.groupBy("space", "surrogate").agg(F.min(F.struct("kind", "canonical")).alias("first"), F.count("*").alias("n"))
        again = first.where("n > 1").join(table, ["space", "surrogate"]).where("not (kind = first.kind AND canonical = first.canonical)")
        real = table.select("space", F.col("canonical").alias("surrogate")).distinct()
        clash = again.select("kind", "canonical").unionByName(table.join(real, ["space", "surrogate"], "left_semi").select("kind", "canonical")).distinct()
        clash = cut_lineage(clash.withColumn("clash", F.lit(1)))
        if clash.isEmpty():
            return table.select("kind", "canonical", "surrogate")
        table = table.join(clash, ["kind", "canonical"], "left").select(
            "kind", "canonical", (F.col("attempt") + F.coalesce("clash", F.lit(0))).alias("attempt"))


def _rendered():
    """A surrogate in the form of the mention: its separators and its capitals."""
    piece, s = F.col("piece"), F.col("surrogate")
    placed = F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(piece), F.lit(1))), lambda i: F.when(
        F.regexp_like(F.substring(piece, i, F.lit(1)), _lit(r"^[\dA-Z]$")),
        F.substring(s, F.char_length(F.regexp_replace(F.substring(piece, F.lit(1), i), r"[^\dA-Z]", "")), F.lit(1)))
        .otherwise(F.substring(piece, i, F.lit(1)))), "")
    return (F.when(F.col("kind").isNull(), piece)
            .when(F.col("kind").isin(*DIGIT_KINDS, "iban"), placed)
            .when(F.col("kind").isin("surname", "given", "given_f", "given_m"),
                  F.when(F.upper(piece) == piece, F.upper(s)).otherwise(F.initcap(s)))
            .when(F.col("kind").isin("mailbox", "domain") & (F.upper(piece) == piece) & (F.lower(piece) != piece), F.upper(s)).otherwise(s))


def replace_entities(docs, key="surrogates"):
    """Texts with personal data replaced by surrogates.

    ``docs`` needs doc_id and text. Returns one row per input row: doc_id, text
    (replaced), n_entities, kinds (of each mention, in order), surrogates (what
    stands there now). Old values are not returned.

    The same entity under the same ``key`` always gets the same surrogate,
    whatever its format; different entities get different ones, and no
    surrogate is an entity of the data (see surrogate_table). Surrogates keep
    kind, length and separators of numbers, first digits and check digits of
    cards, top-level domains (equal domains stay equal), key prefixes, and the
    script (Latin, Cyrillic or Greek), capitals and, after a form of address,
    gender of names.

    A name is found after a form of address, and then wherever it stands alone
    in the same text with a capital first or in capitals. Names of texts that
    never give them with a form of address, and names in scripts without
    capitals, are not found.

    Null text stays null with no entities, empty text stays empty. Rows without
    an entity are returned as they are and never move. Repeated rows are
    treated alike. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sign = F.coalesce(F.regexp_like("text", _lit(SIGN)), F.lit(False))
    all_ = F.when(sign, F.regexp_extract_all("text", _lit(_any()), F.lit(0))).otherwise(F.expr("cast(array() as array<string>)"))
    hit = cut_lineage(docs.where(sign).withColumn("found", all_).where(F.size("found") > 0).withColumn("names", _names(F.col("found")))
                       .withColumn("found", F.when(F.col("names").isNull(), F.col("found")).otherwise(F.regexp_extract_all("text", _any_or(F.col("names")), F.lit(0))))
                       .withColumn("row", F.monotonically_increasing_id()))
    found = cut_lineage(mentions(hit))
    table = surrogate_table(found.where("kind is not null"), key)
    new = found.join(table, ["kind", "canonical"], "left").select("row", "place", "part", "type", _rendered().alias("new"))
    new = new.groupBy("row", "place", "type").agg(F.sort_array(F.collect_list(F.struct("part", "new"))).alias("parts"))
    new = new.withColumn("new", F.array_join(F.col("parts.new"), ""))
    new = new.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", "type", "new"))).alias("all"))
    between = F.when(F.col("names").isNull(), F.split("text", _any(), -1)).otherwise(F.split("text", _any_or(F.col("names")), -1))
    text = F.array_join(F.zip_with(between, F.col("all.new"), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    done = hit.join(new, "row").select("doc_id", text.alias("text"), F.size("all").cast("long").alias("n_entities"),
                                       F.col("all.type").alias("kinds"), F.col("all.new").alias("surrogates"))
    none = F.expr("cast(array() as array<string>)")
    has = sign & F.regexp_like("text", _lit(_any()))
    rest = docs.where(~F.coalesce(has, F.lit(False))).select("doc_id", "text", F.lit(0).cast("long").alias("n_entities"), none.alias("kinds"), none.alias("surrogates"))
    return rest.unionByName(done)
