"""Operator 8 — information-theoretic sanitisation (DataFrame/SQL only).

Protected entities are the e-mail addresses, IP addresses, card and phone
numbers of the texts.  Words near an entity may reveal it as well: how strongly
is estimated from co-occurrence over the whole corpus.  With N documents,
df(t) documents holding the term t, df(e) holding the entity e and c(t, e)
holding t within ``CONTEXT`` (120) characters of e,

    PMI(t; e) = log2(N c(t, e) / (df(t) df(e))),   IC(e) = −log2(df(e) / N),

and t discloses the share PMI / IC of e's information.  A term seen near the
entity in ``min_support`` documents (2) that discloses ``generalise_at`` (0.8)
of it is generalised, from ``remove_at`` (0.95) on it is removed, wherever it
stands near that entity.  Terms are runs of three or more letters that belong
to no address or number; df(t) counts every run of letters.

Positions come without any row code: a text's matches and the pieces between
them give all lengths, summed in chunks so that texts with very many matches
stay cheap.  What stands near an entity is put together from the pieces and
matches around it, whatever else matches there: years, house numbers and
neighbouring addresses do not end it.  The patterns are linear in the text: runs are taken possessively
and matches start only where a run starts.  Counting and joining work on rows
of (entity, term), aggregated before they are shuffled.

Null texts are empty texts; rows that agree in id and text have equal results;
each row of the input gives one row; an entity in all documents discloses
nothing.  Other columns are ignored.  Of overlapping spans ``clean`` replaces
the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, prepare, read

KINDS = ("email", "ip", "card", "phone")
CONTEXT = 120
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: a text without this cannot match
_NEEDS = {"email": "contains(t, '@')", "ip": "contains(t, '.')", "card": "true", "phone": "contains(t, '+')"}
TERM = r"(?<![\p{L}\p{N}@._%+-])\p{L}{3,}+(?![\p{N}@_%+-])(?!\.[\p{L}\p{N}])"
PUT = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
_CHUNK = 256


def _let(name: str, value: str, body: str) -> str:
    """``value`` once, under a name."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _located(text: str, pattern: str, tag: str, valid: str, row: str) -> str:
    """Array of ``row`` for each match of ``pattern`` in the SQL value ``text``
    that is ``valid``.  Both see the match as x: start and end (code points),
    value, and its number i; ``row`` also sees the matches h_tag and the pieces
    of text around them, p_tag."""
    h, p, g, o, c = (f"{x}_{tag}" for x in "hpgoc")
    match = (f"named_struct('start', {c}[i div {_CHUNK}] + aggregate(slice({g}, cast(i div {_CHUNK} as int) * {_CHUNK} + 1, i % {_CHUNK}), 0, (a, x) -> a + x) + length({p}[i]),"
             f" 'end', {c}[i div {_CHUNK}] + aggregate(slice({g}, cast(i div {_CHUNK} as int) * {_CHUNK} + 1, i % {_CHUNK} + 1), 0, (a, x) -> a + x),"
             f" 'value', m, 'i', i)")
    # a text without a match is not split
    return _let(h, f"regexp_extract_all({text}, r'{pattern}', 0)",
                _let(p, f"if(size({h}) = 0, array(), split({text}, r'{pattern}', -1))",
                     _let(g, f"transform({h}, (m, i) -> length({p}[i]) + length(m))",
                          _let(o, f"transform(sequence(0, cast((size({h}) - 1) div {_CHUNK} as int)), k -> aggregate(slice({g}, k * {_CHUNK} + 1, {_CHUNK}), 0, (a, x) -> a + x))",
                               _let(c, f"transform({o}, (s, k) -> aggregate(slice({o}, 1, k), 0, (a, x) -> a + x))",
                                    f"transform(filter(transform({h}, (m, i) -> {match}), x -> {valid}), x -> {row})")))))


def _near(side: str, tag: str) -> str:
    """The ``CONTEXT`` characters before or after match x, less a word that the
    cut would split.  A match and the piece behind it have three characters at
    least, so a third as many pieces as characters reach far enough."""
    h, p, far = f"h_{tag}", f"p_{tag}", CONTEXT // 3
    if side == "left":
        whole = (f"array_join(transform(sequence(greatest(x.i - {far}, 0), x.i), j -> concat(right({p}[j], {CONTEXT}),"
                 f" if(j < x.i, right({h}[j], {CONTEXT}), ''))), '')")
        return f"if(x.start > {CONTEXT}, regexp_replace(right({whole}, {CONTEXT}), r'^[^\\s]+', ''), {whole})"
    whole = (f"array_join(transform(sequence(x.i + 1, least(x.i + 1 + {far}, size({p}) - 1)), j -> concat(left({p}[j], {CONTEXT + 1}),"
             f" if(j < size({h}), left({h}[j], {CONTEXT + 1}), ''))), '')")
    cut = f"if(length(w) > {CONTEXT}, regexp_replace(left(w, {CONTEXT}), r'[^\\s]+$', ''), w)"
    return _let("w", whole, cut)


_DIGITS = "regexp_replace(x.value, '[^0-9]', '')"
_LUHN = " + ".join(
    f"cast(substr(d, {i + 1}, 1) as int)" if (18 - i) % 2 == 0 else
    f"cast(substr('0246813579', cast(substr(d, {i + 1}, 1) as int) + 1, 1) as int)" for i in range(19))
_VALID = {
    "email": "true",
    "ip": "forall(split(x.value, '[.]'), n -> length(trim(leading '0' from n)) < 4 and coalesce(try_cast(trim(leading '0' from n) as int), 0) <= 255)",
    "card": f"length({_DIGITS}) between 14 and 19 and ({_let('d', f'lpad({_DIGITS}, 19, chr(48))', _LUHN)}) % 10 = 0",
    "phone": f"length({_DIGITS}) between 10 and 15",
}
_NORMAL = {"email": "lower(x.value)", "ip": "x.value", "card": _DIGITS, "phone": _DIGITS}


def entities(text: Column) -> Column:
    """array of (start, rank, end, kind, entity, terms): the base spans of a
    text and the (term, start, end) near each."""
    parts = []
    for rank, kind in enumerate(KINDS):
        near = []
        for side, base in (("left", "x.start - length(n)"), ("right", "x.end")):
            term = f"named_struct('term', lower(x.value), 'start', x.start, 'end', x.end)"
            terms = _located("n", TERM, f"{kind}_{side}", "true", term)
            moved = f"transform({terms}, y -> named_struct('term', y.term, 'start', y.start + {base}, 'end', y.end + {base}))"
            near.append(_let("n", _near(side, kind), moved))
        row = (f"named_struct('start', x.start, 'rank', {rank}, 'end', x.end, 'kind', '{kind}',"
               f" 'entity', xxhash64('{kind}', {_NORMAL[kind]}), 'terms', concat({near[0]}, {near[1]}))")
        parts.append(f"if({_NEEDS[kind]}, {_located('t', PATTERNS[kind], kind, _VALID[kind], row)}, null)")
    lists = ", ".join(f"coalesce({p}, array())" for p in parts)
    rows = F.expr(f"transform(array(coalesce(`_text`, '')), t -> array_sort(concat({lists})))[0]")
    return rows


def base_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, found): the base spans of every row; mark is the text's hash."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    return texts.select("doc_id", F.xxhash64("_text").alias("mark"), entities(F.col("_text")).alias("found"))


def disclosure(found: DataFrame, docs: DataFrame, min_support: int, generalise_at: float) -> DataFrame:
    """(entity, term, share) of the terms that disclose an entity."""
    n = docs.count()
    hits = found.where(F.size("found") > 0)
    each = hits.select(F.explode(F.array_distinct(F.col("found.entity"))).alias("entity"))
    df_e = each.groupBy("entity").agg(F.count(F.lit(1)).alias("df_e"))
    pairs = F.expr("array_distinct(flatten(transform(found, x -> transform(x.terms, y -> named_struct('entity', x.entity, 'term', y.term)))))")
    both = durable(hits.select(F.explode(pairs).alias("p")).groupBy("p.entity", "p.term")
                   .agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= min_support))
    terms = durable(both.select("term").distinct())
    words = docs.select(F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("term"))
    df_t = words.join(terms, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("df_t"))
    gain = (F.log2(F.col("c").cast("double") * n / (F.col("df_t") * F.col("df_e")))
            / F.nullif(F.log2(n / F.col("df_e").cast("double")), F.lit(0.0)))
    return durable(both.join(df_t, "term").join(df_e, "entity").withColumn("share", gain)
                   .where(F.col("share") >= generalise_at).select("entity", "term", "share"))


def spans(docs: DataFrame, min_support: int = 2, generalise_at: float = 0.8, remove_at: float = 0.95) -> DataFrame:
    """One row per document: doc_id, mark and spans, an array of (start, rank,
    end, kind, put): the base spans and the disclosing terms (kind ``term``),
    with what replaces them."""
    prepare(docs.sparkSession)
    found = durable(base_spans(docs))
    telling = disclosure(found, docs, min_support, generalise_at)
    near = (found.where(F.size("found") > 0).select("doc_id", "mark", F.explode("found").alias("x"))
            .select("doc_id", "mark", "x.entity", F.explode("x.terms").alias("y"))
            .select("doc_id", "mark", "entity", "y.term", "y.start", "y.end").join(telling, ["entity", "term"]))
    put = F.when(F.col("share") >= remove_at, "").otherwise("[WORD]")
    # of equal spans the strongest decision counts; terms of one document only
    more = durable(near.groupBy("doc_id", "mark", "start", "end").agg(F.min(put).alias("put"))
                   .groupBy("doc_id", "mark")
                   .agg(F.collect_list(F.struct("start", F.lit(len(KINDS)).alias("rank"), "end", F.lit("term").alias("kind"), "put")).alias("more"))
                   .select(F.col("doc_id").alias("i"), F.col("mark").alias("m"), "more"))
    puts = F.create_map(*(F.lit(x) for kv in PUT.items() for x in kv))
    base = F.transform("found", lambda x: F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["end"].alias("end"),
                                                   x["kind"].alias("kind"), puts[x["kind"]].alias("put")))
    joined = found.join(more, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("mark") == F.col("m")), "left")
    return joined.select("doc_id", "mark", base.alias("base"),
                         F.when(F.col("more").isNull(), base).otherwise(F.array_sort(F.concat(base, "more"))).alias("spans"))


def clean(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, text) with every span replaced."""
    of = spans(docs, **how).groupBy("doc_id", "mark").agg(F.first("spans").alias("spans"))
    of = durable(of.select(F.col("doc_id").alias("i"), F.col("mark").alias("m"), "spans"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    fold = ("aggregate(spans, named_struct('pos', 0, 'parts', cast(array() as array<string>)), (a, s) -> if(s.start < a.pos, a,"
            " named_struct('pos', s.end, 'parts', concat(a.parts, array(substring(text, a.pos + 1, s.start - a.pos), s.put)))),"
            " a -> concat(array_join(a.parts, ''), substring(text, a.pos + 1)))")
    return (texts.join(of, F.col("doc_id").eqNullSafe(F.col("i")) & (F.xxhash64("text") == F.col("m")))
            .select("doc_id", F.expr(fold).alias("text")))


def _digest(column: str) -> str:
    return f"array_join(transform({column}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"


def query(spark, sf_dir: str) -> DataFrame:
    rows = spans(read(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = (F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in KINDS)
    return rows.select("doc_id", *counts, F.expr(f"sha2({_digest('base')}, 256)").alias("base_sha256"),
                       F.expr(_digest("spans")).alias("spans"),
                       F.expr("cast(size(filter(spans, s -> s.kind = 'term')) as long)").alias("n_term"))
