"""Column functions over names, keys, codes and labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradelens.functions.config import BRACKETS, COMMITTEE_SECTORS, ENTITY_WORDS, PLANNED


def literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def entity_name_norm(name: Column) -> Column:
    """Issuer name without instrument words, punctuation and short leading or trailing tokens; null if nothing is left."""
    s = low = F.lower(name)
    for word in ("cmn class a", "common stock"):
        s = F.replace(s, F.lit(word), F.lit(" "))
    for pattern in (r"\bcm[i|l]?n\b", r"\bclass\s+[a-z]\b", r"\bsponsored\s+adr\b", r"\badr\b", r"^[^a-z0-9]+", r"\boc\b", r"[^a-z0-9]+"):
        s = F.regexp_replace(s, pattern, " ")
    # each instrument word holds one of these; names without them only lose their punctuation
    s = F.when(F.rlike(low, F.lit("cm|class|adr|oc")), s).otherwise(F.regexp_replace(low, r"[^a-z0-9]+", " "))
    tokens = F.split(F.trim(s), " +")

    def dropped(words: Column, longer: int) -> Column:
        """How many leading words of at most ``longer`` characters go while more than two are left."""
        n = F.size(words)
        first = F.array_position(F.transform(words, lambda t: F.length(t) > longer), True).cast("int")
        return F.least(F.when(first > 0, first - 1).otherwise(n), F.greatest(n - 2, F.lit(0)))

    # one-element arrays name a value once, so that the expression does not repeat what it is made of
    named = lambda value, f: F.element_at(F.transform(F.array(value), f), 1)
    rest = named(tokens, lambda t: F.slice(t, dropped(t, 2) + 1, F.size(t)))
    kept = named(F.reverse(rest), lambda t: F.slice(t, dropped(t, 1) + 1, F.size(t)))
    return F.nullif(F.array_join(F.reverse(kept), " "), F.lit(""))


HONORIFICS = ("hon", "honorable", "rep", "representative", "sen", "senator", "mr", "mrs", "ms", "dr")


def filer_name_norm(name: Column) -> Column:
    """Lower-case filer name in first-last order, letters only; null if nothing is left. Honorifics go in turn, also in front of longer words."""
    s = F.lower(name)
    for word in HONORIFICS:
        s = F.regexp_replace(s, rf"\b{word}\.?\s*", "")
    comma = F.instr(s, ",")
    swapped = F.concat_ws(" ", F.trim(F.substring(s, comma + 1, F.length(s))), F.trim(F.substring_index(s, ",", 1)))
    s = F.regexp_replace(F.when(comma > 0, swapped).otherwise(s), r"[^a-z\s]", "")
    return F.nullif(F.trim(F.regexp_replace(s, r"\s+", " ")), F.lit(""))


def senator_name_norm(name: Column) -> Column:
    """Upper-case name; each known title in front and each known suffix behind goes once, in turn."""
    s = F.upper(F.trim(name))
    for pattern in ("^SENATOR ", r"^SEN\. ", r"^HON\. ", r" JR\.$", " JR$", " III$", " II$", " IV$"):
        s = F.regexp_replace(s, pattern, "")
    return F.trim(F.regexp_replace(s, r"\s+", " "))


TICKER_ALIASES = {"GOOG": "GOOGL", "BRK.A": "BRK-B", "BRK/A": "BRK-B", "BF.B": "BF-B", "BF/B": "BF-B"}


def ticker_canonical(ticker: Column) -> Column:
    t = F.upper(F.trim(ticker))
    return F.coalesce(F.element_at(literal_map(TICKER_ALIASES), t), t)


def txn_type_norm(text: Column) -> Column:
    """purchase, sale_partial, sale, exchange or unknown, by the first word that occurs."""
    s = F.lower(F.coalesce(text, F.lit("")))
    has = lambda w: F.contains(s, F.lit(w))
    return F.when(has("purchase"), "purchase").when(has("sale") & has("partial"), "sale_partial").when(has("sale"), "sale").when(has("exchange"), "exchange").otherwise("unknown")


def owner_norm(text: Column) -> Column:
    """self, spouse, joint or dependent; other texts pass in lower case, blank ones are self."""
    s = F.lower(F.trim(F.coalesce(text, F.lit(""))))
    return F.when(s == "", "self").otherwise(F.coalesce(F.element_at(literal_map({"dependent child": "dependent", "child": "dependent"}), s), s))


def direction(action: Column) -> Column:
    return F.when(action.isin("purchase", "P"), "BUY").when(action.isin("sale", "sale_partial", "sale_full", "S"), "SELL").otherwise("NEUTRAL")


def _money(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("")).try_cast("long")


def amount_bracket(text: Column) -> Column:
    """struct(low, high) of a statutory range, a written ``$a - $b`` range, or ``Over $x``."""
    chain = None
    for name, low, high in BRACKETS:
        value = F.struct(F.lit(low).cast("long").alias("low"), F.lit(high).cast("long").alias("high"))
        chain = F.when(F.contains(text, F.lit(name)), value) if chain is None else chain.when(F.contains(text, F.lit(name)), value)
    pair = r"\$([\d,]+)\s*-\s*\$([\d,]+)"
    over = r"(?i)over\s+\$([\d,]+)"
    low = _money(F.regexp_extract(text, pair, 1))
    above = _money(F.regexp_extract(text, over, 1))
    chain = chain.when(F.rlike(text, F.lit(pair)), F.struct(low.alias("low"), _money(F.regexp_extract(text, pair, 2)).alias("high")))
    return chain.when(F.rlike(text, F.lit(over)), F.struct((above + 1).alias("low"), ((above + 1) * 2).alias("high")))


TXN_CLASSES = {"P": "open_market_buy", "S": "open_market_sell", "M": "option_exercise", "F": "tax_withhold", "A": "award_grant", "G": "gift"}


def txn_class(code: Column) -> Column:
    return F.when(F.coalesce(code, F.lit("")) == "", "unknown").otherwise(F.coalesce(F.element_at(literal_map(TXN_CLASSES), F.upper(code)), F.lit("other")))


LEADERS = [
    ("ceo", r"\bceo\b|\bchief executive officer\b"),
    ("cfo", r"\bcfo\b|\bchief financial officer\b|\bprincipal financial officer\b"),
    ("chair", r"\bchairman\b|\bchairwoman\b|\bchairperson\b|\bchair of the board\b|\bexecutive chair\b|\bexec\.?\s*chair\b"),
    ("president", r"(?<!\bvice )(?<!\bvice)\bpresident\b"),
    ("coo", r"\bchief operating officer\b|\bcoo\b"),
]
FORMER = r"\bformer\b|\bex-|\bfmr\b|\bretired\b|\bpast\b"


def role_class(title: Column, owner: Column, is_officer: Column, is_director: Column, is_ten_pct: Column, is_other: Column) -> Column:
    """struct(role, reason): the first rule that applies; a titled officer outside the top roles has a reason too."""
    t = F.lower(title)
    entity = "|".join(rf"\b{w}\b" for w in ENTITY_WORDS)

    def out(role: str, reason: Column | None = None) -> Column:
        return F.struct(F.lit(role).alias("role"), (reason if reason is not None else F.lit(None).cast("string")).alias("reason"))

    has_title = F.coalesce(title, F.lit("")) != ""
    chain = (
        F.when(F.coalesce(F.rlike(F.lower(owner), F.lit(entity)), F.lit(False)), out("excluded", F.concat(F.lit("entity_name: "), owner)))
        .when(is_ten_pct & ~is_officer & ~is_director, out("excluded", F.lit("ten_pct_holder_only")))
        .when(is_other & ~is_officer, out("excluded", F.lit("other_relationship_no_officer_role")))
        .when(has_title & F.rlike(t, F.lit(FORMER)), out("excluded", F.concat(F.lit("former_officer: "), title)))
    )
    for role, pattern in LEADERS:
        chain = chain.when(has_title & F.rlike(t, F.lit(pattern)), out(role))
    return chain.when(is_director & ~is_officer, out("excluded", F.lit("director_only"))).when(is_officer, out("officer_other", F.when(has_title, F.concat(F.lit("officer_not_top_leadership: "), title)))).otherwise(out("excluded", F.lit("no_officer_role")))


def planned_trade(footnotes: Column, flag: Column | None = None) -> Column:
    found = F.coalesce(reduce(lambda a, b: a | b, [F.contains(F.lower(footnotes), F.lit(k)) for k in PLANNED]), F.lit(False))
    return found if flag is None else found | F.coalesce(flag, F.lit(False))


def subject_key(ticker: Column, cik: Column | None = None) -> Column:
    own = F.concat(F.lit("entity:"), F.lower(ticker))
    return own if cik is None else F.coalesce(own, F.concat(F.lit("cik:"), cik))


def ticker_of(key: Column) -> Column:
    return F.upper(F.replace(key, F.lit("entity:"), F.lit("")))


def fingerprint(ids: Column, *parts: Column) -> Column:
    """SHA-256 of the sorted ids and further parts joined by ``|``; ``ids`` is an array column."""
    return F.sha2(F.concat_ws("|", F.array_join(F.array_sort(ids), "|"), *parts), 256)


def committee_sectors(codes: Column) -> Column:
    """Sorted distinct sectors of an array of committee codes; subcommittees inherit by their first four characters."""
    table = F.create_map(*[x for k, v in COMMITTEE_SECTORS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    found = F.transform(codes, lambda c: F.coalesce(F.element_at(table, F.lower(F.substring(c, 1, 4))), F.array().cast("array<string>")))
    return F.array_sort(F.array_distinct(F.flatten(found)))


def filing_format(doc_id: Column) -> Column:
    return F.when(F.startswith(doc_id, F.lit("822")), "paper").when(doc_id.isNotNull(), "electronic")


def asset_name_plausible(name: Column) -> Column:
    letters = F.length(F.regexp_replace(name, "[^A-Za-z]", ""))
    return (F.length(name) >= 3) & ~F.rlike(name, F.lit(r"^[\d|\s]+$")) & (letters >= 4) & (letters / F.length(name) >= 0.45) & F.rlike(name, F.lit("[A-Za-z]{3,}"))
