r"""Personal data: exact spans of four kinds, and the terms that give protected entities away.

Base spans are the leftmost non-overlapping matches of a kind's pattern that pass its check.  A pattern's
matches and the pieces between them come from two scans of the text, and their running lengths give the
positions (code points, end exclusive).  The patterns below match what the plain ones in their
comments match, but never try a place twice: runs are possessive, and a match starts only at the
start of a run or right after the last match, so a text without matches costs one pass.

Disclosure.  An entity is a kind with its normalised value; those found in at least ``min_docs`` documents
are protected against inference.  With n_c, n_t and n_ct the documents (of N) that hold the entity, the
term, both, a term gives away the share

    log2(n_ct N / (n_c n_t)) / log2(N / n_c)

of the entity's information: 1 if the term never occurs without it.  Terms (runs of at least three letters,
lower-cased) that reach ``generalise`` in documents holding the entity become spans there and are
generalised to their kind; those that reach ``remove`` are removed.  n_t counts all documents.  A term
can reach the share only if n_t <= n_c ** g * N ** (1 - g), so frequent terms drop out before any
pair of term and entity is made.

Defined results: a null or empty text has no spans; repeated rows get the same spans each; they count
once for entities, each for n_t and N; a row with a null id is a document like others; terms that overlap a base span are not
spans; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import free_name, written

KINDS = ("email", "ip", "card", "phone", "term")
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text with a match surely holds; cheap to look for.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]++\.", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": "+"}
TERM = r"\p{L}{3,}"
SPAN = "array<struct<start:int,kind_no:int,end:int,value:string>>"


def _spans(text: Column, kind: str, pattern: str, keep) -> Column:
    """Spans of the matches for whose value ``keep`` holds."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    pairs = F.zip_with(matches, gaps, lambda m, gap: F.struct(m.alias("m"), gap.alias("gap")))
    number = F.lit(KINDS.index(kind))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["m"])
        span = F.array(F.struct(start.alias("start"), number.alias("kind_no"), end.alias("end"), x["m"].alias("value")))
        return F.struct(F.coalesce(end, acc["at"]).alias("at"),
                        F.when(x["m"].isNotNull() & keep(x["m"]), F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    none = F.array().cast(SPAN)
    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("out")), add, lambda acc: acc["out"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


CHECKS = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: F.forall(F.split(v, r"\."), lambda x: x.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")),
    "card": lambda v: F.length(_digits(v)).between(12, 19) & F.call_function("luhn_check", _digits(v)),
    "phone": lambda v: F.length(_digits(v)).between(9, 15),
}


def base_spans(text: Column) -> Column:
    """Sorted array of (start, kind_no, end, value)."""
    none = F.array().cast(SPAN)
    found = []
    for kind, pattern in PATTERNS.items():
        hint = text.contains(HINTS[kind]) if len(HINTS[kind]) == 1 else text.rlike(HINTS[kind])
        found.append(F.when(hint, _spans(text, kind, pattern, CHECKS[kind])).otherwise(none))
    return F.array_sort(F.concat(*found))


def digest_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind_no"]), s["start"], s["end"])), ",")


def _entity(span: Column) -> Column:
    plain = F.when(span["kind_no"] >= 2, _digits(span["value"])).otherwise(F.lower(span["value"]))
    return F.xxhash64(span["kind_no"], plain)


def _terms(text: Column) -> Column:
    """Hashes of a text's distinct terms."""
    return F.array_distinct(F.transform(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)), lambda x: F.xxhash64(x)))


def revealing_terms(found: DataFrame, docs: DataFrame, min_docs: int, generalise: float) -> DataFrame:
    """(id, th, terms): for documents of ``found`` (id, th, t, base) the term hashes that give away an entity they
    hold, with the share; ``docs`` (th, t, id) is the whole corpus."""
    total = docs.count()
    held = found.select("id", "th", F.explode(F.array_distinct(F.transform("base", lambda s: _entity(s)))).alias("c"))
    frequent = held.groupBy("c").agg(F.count("*").alias("nc")).where(F.col("nc") >= min_docs)
    protected = (held.join(frequent, "c").groupBy("id", "th").agg(F.collect_list(F.struct("c", "nc")).alias("entities"), F.max("nc").alias("most")))
    most = lambda n: F.pow(n, F.lit(generalise)) * F.pow(F.lit(float(max(total, 1))), F.lit(1 - generalise)) * (1 + 1e-9)
    protected = written(protected, "protected")
    limit = protected.agg(F.max("most")).first()[0]
    if limit is None:
        return protected.select("id", "th", F.array().cast("array<struct<term:bigint,share:double>>").alias("terms"))
    counts = docs.select(F.explode(_terms(F.col("t"))).alias("term")).groupBy("term").agg(F.count("*").alias("nt"))
    counts = counts.where((F.col("nt") >= min_docs) & (F.col("nt") <= most(F.lit(float(limit)))))
    same = (F.col("f.id").eqNullSafe(F.col("p.id"))) & (F.col("f.th") == F.col("p.th"))
    rows = found.alias("f").join(protected.alias("p"), same).select("f.id", "f.th", "entities", "most", F.explode(_terms(F.col("t"))).alias("term"))
    rows = rows.join(counts, "term").where(F.col("nt") <= most(F.col("most")))
    pairs = rows.select("id", "th", "term", "nt", F.explode("entities").alias("e")).where(F.col("nt") <= most(F.col("e.nc")))
    pairs = written(pairs.select("id", "th", "term", "nt", "e.c", "e.nc"), "term-entity")
    n = F.lit(float(max(total, 1)))
    share = F.try_divide(F.log2(F.col("nct") * n / (F.col("nc") * F.col("nt"))), F.log2(n / F.col("nc")))
    strong = (pairs.groupBy("c", "term", "nc", "nt").agg(F.count("*").alias("nct")).where(F.col("nct") >= min_docs)
              .select("c", "term", share.alias("share")).where(F.col("share") >= generalise - 1e-12))
    return (pairs.join(strong, ["c", "term"]).groupBy("id", "th", "term").agg(F.max("share").alias("share"))
            .groupBy("id", "th").agg(F.collect_list(F.struct("term", "share")).alias("terms")))


def _sanitised(text: Column, spans: Column, terms: Column, remove: float) -> Column:
    """The text with base spans and generalised terms as their kind in brackets, and removed terms gone."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    gone = F.transform(F.filter(terms, lambda x: x["share"] >= remove), lambda x: x["term"])

    def add(acc: Column, s: Column) -> Column:
        shown = F.when((s["kind_no"] == 4) & F.array_contains(gone, F.xxhash64(F.lower(s["value"]))), "").otherwise(F.get(names, s["kind_no"]))
        before = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], before, F.when(s["start"] >= acc["at"], shown).otherwise("")).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(spans, start, add, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 3, generalise: float = 0.9,
             remove: float = 0.97) -> DataFrame:
    """``docs`` with ``base`` and ``all_spans`` (arrays of start, kind_no, end, value; kinds are KINDS) and
    ``sanitised`` text; columns of these names are replaced."""
    made = ("base", "all_spans", "sanitised")
    pii, of_id, of_hash, own = (free_name(c, docs) for c in ("_pii", "_id", "_th", "_own"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("t"))
    found = rows.withColumn("base", base_spans(F.col("t"))).where(F.size("base") > 0)
    found = written(found.dropDuplicates(["id", "th"]), "base-spans")
    terms = written(revealing_terms(found, rows, min_docs, generalise), "revealing-terms").alias("r")
    same = F.col("f.id").eqNullSafe(F.col("r.id")) & (F.col("f.th") == F.col("r.th"))
    out = found.alias("f").join(terms, same, "left").select("f.*", F.col("r.terms").alias("terms"))
    known = F.transform("terms", lambda x: x["term"])
    hits = F.when(F.size("terms") > 0, _spans(F.col("t"), "term", TERM, lambda v: F.array_contains(F.col("known"), F.xxhash64(F.lower(v)))))
    free = F.filter(F.coalesce(F.col("hits"), F.array().cast(SPAN)),
                    lambda s: ~F.exists(F.col("base"), lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))
    out = out.withColumn("known", known).withColumn("hits", hits).withColumn("all_spans", F.array_sort(F.concat("base", free)))
    out = out.select(F.struct("base", "all_spans", _sanitised(F.col("t"), F.col("all_spans"), F.coalesce("terms", F.array().cast("array<struct<term:bigint,share:double>>")), remove).alias("sanitised")).alias(pii),
                     F.col("id").alias(of_id), F.col("th").alias(of_hash))
    other = [F.col(f"`{c}`") for c in docs.columns if c not in made]
    # the hash as a column, so that the text itself travels only where it is asked for
    joined = docs.withColumn(own, F.xxhash64(text)).join(
        written(out, "sanitised"), F.col(id_col).eqNullSafe(F.col(of_id)) & (F.col(own) == F.col(of_hash)), "left")
    none = F.array().cast(SPAN)
    return joined.select(*other, F.coalesce(f"{pii}.base", none).alias("base"), F.coalesce(f"{pii}.all_spans", none).alias("all_spans"),
                         F.coalesce(f"{pii}.sanitised", F.col(text_col)).alias("sanitised"))
