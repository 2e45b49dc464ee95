"""Personal data: fixed kinds by pattern, further identifiers by bootstrapped contexts.

Base spans come from one regular expression per kind and a check of every
match.  Beyond them, identifier-shaped tokens (at least eight letters, digits,
``_`` or ``-`` with two digits, of any length) and base spans are instances; the
two words before one are its pattern.  Seeds (every base span, and long
hexadecimal secrets) are accepted from the start.  In each round a pattern
scores the share of its distinct instances that are accepted; patterns that
reach ``confidence`` with ``support`` accepted instances are trusted, and their
instances accepted.  Rounds go on until no pattern is added.  Accepted tokens
are reported as kind ``id`` wherever they occur.

All of it is DataFrame expressions.  Positions are code points.  A text's
matches become rows: the lengths of what lies between matches, and the matches
themselves, are summed by a window over the text's rows, so the work grows in
proportion to a text's matches.  Texts are rewritten in blocks.

The expressions below are the stated ones, written so that Java's engine needs
neither recursion nor quadratic time: possessive loops where what follows
cannot match the loop's characters, a start only where a run begins (or the
match before ended), and no match where the check on digits would drop it.

Defined cases: null text is empty; texts without any match have zero counts and
empty spans; repeated rows are reported each; an empty table gives an empty
result; tokens that touch a base span are no instances and not reported;
further columns are ignored or carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelens.llm.frames import packed_row, stored, text_key, unpacked_row

EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?:(?<![0-9])(?<![0-9][ -])|\G)[0-9](?:[ -]?[0-9]){12,}+"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: An identifier-shaped token.
TOKEN = r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9][A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{8,}+"
SECRET = r"^(?=[0-9]*[a-f])(?=[a-f]*[0-9])[0-9a-f]{32,}$"
#: The last two words before a match, read backwards; digits and punctuation separate words.
BEFORE = r"^[^\p{L}=:#]*+[\p{L}=:#]*+(?:[^\p{L}=:#]++[\p{L}=:#]++)?"
#: Bootstrapping: accepted instances that a pattern needs, and their share.
SUPPORT, CONFIDENCE = 5, 0.8
KINDS = ("email", "ip", "card", "phone")
#: Code points of a block in which a text is rewritten.
BLOCK = 4096


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(x: Column) -> Column:
    d = F.reverse(_digits(x))
    total = F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda a, i: a + F.when(
        i % 2 == 1, F.substr(d, i, F.lit(1)).cast("int")).otherwise(
        F.substr(F.lit("0246813579"), F.substr(d, i, F.lit(1)).cast("int") + 1, F.lit(1)).cast("int")))
    return F.length(d).between(13, 19) & (total % 10 == 0)


def _holds(kind: Column, hit: Column) -> Column:
    """Whether a match passes its kind's check."""
    card = F.when(F.length(_digits(hit)).between(13, 19), _luhn(hit)).otherwise(False)
    return (F.when(kind == "ip", hit.rlike(rf"^{PART}(?:\.{PART}){{3}}$")).when(kind == "card", card)
            .when(kind == "phone", F.length(_digits(hit)).between(9, 15)).otherwise(True))


def _matches(kind: str, regex: str, gate: str) -> Column:
    """kind, and for every match: the code points since the one before, the pattern before it, and the match.

    ``gate``: a cheap test that every text with a match passes.
    """
    text = F.col("text")
    between = F.transform(F.split(text, regex, -1), lambda c: F.struct(
        F.length(c).alias("skip"),
        F.trim(F.regexp_replace(F.lower(F.reverse(F.regexp_extract(F.reverse(c), BEFORE, 0))), r"[^\p{L}=:#]+", " ")).alias("pattern")))
    found = F.zip_with(between, F.regexp_extract_all(text, F.lit(regex), F.lit(0)), lambda c, hit: F.struct(
        c["skip"].alias("skip"), c["pattern"].alias("pattern"), hit.alias("hit")))
    return F.struct(F.lit(kind).alias("kind"), F.when(text.rlike(gate) & text.rlike(regex), found).alias("found"))


def occurrences(docs: DataFrame) -> DataFrame:
    """key, kind (a base kind or ``token``), start, end, hit, pattern of the distinct texts; tokens apart from base spans."""
    rows = docs.select(text_key(F.col("text")).alias("key"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    kinds = F.array(_matches("email", EMAIL, "@"), _matches("ip", IP, r"[0-9]\.[0-9]"), _matches("card", CARD, "[0-9][ -]?[0-9][ -]?[0-9]"),
                    _matches("phone", PHONE, r"\+[0-9]"), _matches("token", TOKEN, "[0-9][A-Za-z_-]*+[0-9]"))
    each = rows.select("key", F.inline(kinds)).select("key", "kind", F.posexplode("found").alias("i", "m"))
    each = each.select("key", "kind", "i", "m.skip", "m.hit", "m.pattern").where("hit is not null").distinct().repartition("key")
    so_far = Window.partitionBy("key", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    each = (each.withColumn("end", F.sum(F.col("skip") + F.length("hit")).over(so_far))
            .withColumn("start", F.col("end") - F.length("hit")).where(_holds(F.col("kind"), F.col("hit"))))
    base = F.col("kind") != "token"
    places = ("start", "end", "kind")
    onwards = Window.partitionBy("key").orderBy(*places).rowsBetween(Window.unboundedPreceding, 0)
    backwards = Window.partitionBy("key").orderBy(*(F.desc(c) for c in places)).rowsBetween(Window.unboundedPreceding, 0)
    reach = F.max(F.when(base, F.col("end"))).over(onwards)
    ahead = F.min(F.when(base, F.col("start"))).over(backwards)
    touched = F.coalesce(reach > F.col("start"), F.lit(False)) | F.coalesce(ahead < F.col("end"), F.lit(False))
    return each.withColumn("touched", touched).where(base | ~F.col("touched")).select("key", "kind", "start", "end", "hit", "pattern")


def accepted(found: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """hit: the tokens among ``found`` that trusted patterns vouch for, and the secrets."""
    seed = (F.col("kind") != "token") | F.col("hit").rlike(SECRET)
    edges = stored(found.select("pattern", "hit", seed.alias("seed")).groupBy("pattern", "hit").agg(F.max("seed").alias("seed")), "pii-edges")
    trusted, count = stored(edges.select("pattern").limit(0), "pii-patterns"), 0
    while True:
        by_pattern = edges.join(trusted, "pattern", "left_semi").select("hit")
        known = stored(edges.where("seed").select("hit").union(by_pattern).distinct(), "pii-accepted")
        scored = (edges.join(known.withColumn("known", F.lit(1)), "hit", "left").groupBy("pattern")
                  .agg(F.count("known").alias("s"), F.count(F.lit(1)).alias("n")))
        trusted = stored(scored.where((F.col("pattern") != "") & (F.col("s") >= support) & (F.col("s") >= confidence * F.col("n")))
                         .select("pattern"), "pii-patterns")
        before, count = count, trusted.count()
        if count == before:
            return known


def all_spans(docs: DataFrame) -> DataFrame:
    """key, kind, start, end of every span of the distinct texts; bootstrapped ones have kind ``id``."""
    found = stored(occurrences(docs), "pii-occurrences")
    tokens = found.where("kind = 'token'").join(accepted(found), "hit", "left_semi")
    return (found.where("kind <> 'token'").select("key", "kind", "start", "end")
            .union(tokens.select("key", F.lit("id").alias("kind"), "start", "end")))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    order = F.array_position(F.array(*map(F.lit, (*KINDS, "id"))), F.col("kind")).alias("order")
    by_text = stored(all_spans(docs).groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct(order, "start", "end", "kind"))).alias("found"),
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in KINDS]), "pii-texts")
    name = F.transform("found", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    n_base = sum((F.col(f"n_{k}") for k in KINDS[1:]), F.col(f"n_{KINDS[0]}")).cast("int")
    rows = docs.select("doc_id", text_key(F.col("text")).alias("key")).join(by_text.withColumn("name", name), "key", "left")
    return rows.select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce(F.array_join(F.slice("name", F.lit(1), n_base), ","), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(F.array_join("name", ","), F.lit("")).alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """key, text of the distinct texts that hold spans, every span replaced by its kind in brackets."""
    spans = all_spans(docs)
    before = Window.partitionBy("key").orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    done = F.coalesce(F.max("end").over(before), F.lit(0))  # a span that reaches into one before it is not named, only removed
    spans = stored(spans.withColumn("from", F.greatest("start", done)).withColumn("named", F.col("start") >= done)
                   .where("from < end"), "pii-spans")
    block = spans.select("key", F.explode(F.sequence(F.floor(F.col("from") / BLOCK), F.floor((F.col("end") - 1) / BLOCK))).alias("b"),
                         "from", "end", "kind", "named")
    cut = block.select("key", "b", F.struct(
        F.greatest(F.col("from") - F.col("b") * BLOCK, F.lit(0)).cast("int").alias("from"),
        F.least(F.col("end") - F.col("b") * BLOCK, F.lit(BLOCK)).cast("int").alias("to"),
        F.when(F.col("named") & (F.col("from") >= F.col("b") * BLOCK), F.concat(F.lit("["), F.upper("kind"), F.lit("]")))
        .otherwise("").alias("name")).alias("cut"), F.lit(None).cast("string").alias("block"))

    rows = docs.select(text_key(F.col("text")).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    texts = rows.join(spans.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    pieces = texts.select("key", F.posexplode(F.regexp_extract_all("text", F.lit(r"(?s).{1,%d}+" % BLOCK), F.lit(0))).alias("b", "block"))
    both = cut.unionByName(pieces.select("key", F.col("b").cast("long").alias("b"), F.lit(None).cast(cut.schema["cut"].dataType).alias("cut"), "block"))
    blocks = both.groupBy("key", "b").agg(F.array_sort(F.collect_list("cut")).alias("cuts"), F.max("block").alias("block"))
    walk = F.aggregate(
        "cuts", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, s: F.struct(s["to"].alias("at"), F.concat(
            a["out"], F.substr("block", a["at"] + 1, s["from"] - a["at"]), s["name"]).alias("out")),
        lambda a: F.concat(a["out"], F.substr("block", a["at"] + 1, F.lit(BLOCK))))
    whole = blocks.select("key", F.struct("b", walk.alias("out")).alias("p")).groupBy("key").agg(F.array_sort(F.collect_list("p")).alias("p"))
    return whole.select("key", F.array_join(F.transform("p", lambda x: x["out"]), "").alias("text"))


def redact(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and text with every span replaced by its kind in brackets; null text stays null."""
    clean = stored(redacted(docs).withColumnRenamed("text", "clean"), "pii-redacted")
    rows = docs.select(packed_row(columns), text_key(F.col("text")).alias("key"), "text")
    return rows.join(clean, "key", "left").select(
        *unpacked_row(columns), F.when(F.col("text").isNotNull(), F.coalesce("clean", "text")).alias("text"))
