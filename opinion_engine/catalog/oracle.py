"""SQL for DuckDB with the results that the registered queries must give."""

from __future__ import annotations

from . import adapters, registered
from .registered import SAMPLE_ROWS

# Fixed values, written out here a second time so that a slip in the operators shows.
CAP = 25_000
GRID = (0.1, 0.5, 1.0, 2.0)
NON_LETTERS = r"[^\p{L}]+"

_VIEWS = {
    "reviews": adapters.reviews_sql(),
    "uploads": adapters.uploads_sql(),
    "scored": adapters.select_sql(adapters.SCORED, "labels"),
    "rated": """
        select * exclude (f) replace (case when f is null then null when f < 1 then 1 when f > 5 then 5
                                      else cast(trunc(f) as int) end as star_rating)
        from (select *, try_cast(star_rating as float) as f from reviews)""",
    "with_text": "select * from rated where review_body is not null and review_body <> ''",
    "normal": r"""
        select * replace (
            regexp_replace(trim(lower(review_body), ' '), '[\s\x0B]+', ' ', 'g') as review_body,
            regexp_replace(trim(lower(review_headline), ' '), '[\s\x0B]+', ' ', 'g') as review_headline)
        from with_text""",
    "uniq": """
        select * exclude (rn) from (
            select *, row_number() over (partition by review_body order by review_id) as rn from normal)
        where rn = 1""",
    "valid": """
        select *, length(review_body) as review_length from uniq
        where review_body is not null and review_headline is not null""",
    "labelled": r"""
        select review_id, regexp_replace(review_body, '[\r\n]+', ' ', 'g') as review_body,
            case when star_rating > 3 then 1 else 0 end as label
        from with_text where star_rating is not null and star_rating <> 3""",
    "ranked": """
        select *, row_number() over (partition by label
            order by md5('42:' || cast(review_id as varchar)), review_id) as rn
        from labelled""",
    "size": f"""
        select least(count(*) filter (where label = 1), count(*) filter (where label = 0), {CAP}) as per_class
        from labelled""",
    "sample": "select review_id, label, review_body from ranked where rn <= (select per_class from size)",
    "remaining": """
        select * from labelled l
        where not exists (select 1 from sample s where s.review_body = l.review_body)""",
    "trimmed": "select * replace (trim(review, ' ') as review), lower(trim(review, ' ')) as review_clean from uploads",
    "flagged": r"""
        select *, coalesce(length(review_clean) < 30 or len(list_filter(
            string_split_regex(review_clean, '\s+'), lambda x: x <> '')) < 5, true) as short_review
        from trimmed""",
    "cleaned": r"""
        select * from flagged
        where length(review_clean) > 0 and not regexp_matches(review_clean, '^[0-9\s]+$')""",
    "turns": adapters.select_sql(adapters.TURNS, "conversations"),
    "turns_trimmed": "select * replace (trim(review, ' ') as review), lower(trim(review, ' ')) as review_clean from turns",
    "served": """
        select c.*, case s.prediction when 1 then 'positive' when 0 then 'negative' else 'unknown' end as prediction
        from cleaned c left join scored s on s.doc_id = c.upload_id""",
    "parted": """
        select *, part < 80 as training_part, row_number() over (partition by part < 80, label
            order by md5('42:' || cast(doc_id as varchar)), doc_id) as rn
        from (select doc_id, text, quality as label,
            cast('0x' || substr(md5('42:' || sha256(text)), 1, 8) as bigint) % 100 as part
            from documents join labels using (doc_id))""",
    "class_size": f"""
        select least(count(*) filter (where label = 1), count(*) filter (where label = 0), {CAP}) as per_class
        from parted where training_part""",
    # The whole chain: the training split, its distinct texts, the sample, and the halves of the rest.
    "chain_normal": r"""
        select * replace (
            regexp_replace(trim(lower(review_body), ' '), '[\s\x0B]+', ' ', 'g') as review_body,
            regexp_replace(trim(lower(review_headline), ' '), '[\s\x0B]+', ' ', 'g') as review_headline)
        from with_text where cast('0x' || substr(md5('42:' || cast(review_id as varchar)), 1, 8) as bigint) % 100 < 80""",
    "chain_labelled": r"""
        select review_id, regexp_replace(review_body, '[\r\n]+', ' ', 'g') as review_body,
            case when star_rating > 3 then 1 else 0 end as label
        from (select *, row_number() over (partition by review_body order by review_id) as rn from chain_normal)
        where rn = 1 and review_headline is not null and star_rating is not null and star_rating <> 3""",
    "chain_ranked": """
        select *, row_number() over (partition by label
            order by md5('42:' || cast(review_id as varchar)), review_id) as rn
        from chain_labelled""",
    "chain_size": f"""
        select least(count(*) filter (where label = 1), count(*) filter (where label = 0), {CAP}) as per_class
        from chain_labelled""",
    "chain_judged": """
        select review_id as doc_id, review_body as text, label, rn <= (select per_class from chain_size) as training,
            rn > (select per_class from chain_size) and half < 50 as chosen_on,
            rn > (select per_class from chain_size) and half >= 50 as judged_on
        from (select *, cast('0x' || substr(md5('42:' || sha256(review_body)), 1, 8) as bigint) % 100 as half
            from chain_ranked)""",
    "judged": """
        select *, training_part and rn <= (select per_class from class_size) as training,
            part between 80 and 89 as chosen_on, part >= 90 as judged_on, not training_part as held_out
        from parted""",
}


def _needed(names: list[str]) -> list[str]:
    """The views that the named ones build on, in the order of definition."""
    wanted, before = set(names), set()
    while wanted != before:
        before = set(wanted)
        for name in before:
            words = set(_VIEWS[name].replace("(", " ").replace(")", " ").split())
            wanted |= {other for other in _VIEWS if other != name and other in words}
    return [name for name in _VIEWS if name in wanted]


def _sql(views: str, body: str, extra: str = "") -> str:
    ctes = [f"{name} as ({_VIEWS[name]})" for name in _needed(views.split())]
    return "with " + ", ".join(ctes + ([extra] if extra else [])) + " " + body


def _tokens(name: str, source: str, row_id: str, text: str, keep: str = "") -> str:
    return f"""{name} as (select * from (select distinct {row_id} as doc_id, {keep}
        unnest(string_split_regex(lower({text}), '{NON_LETTERS}')) as token from {source}) where token <> '')"""


def _counts(source: str, where: str = "true") -> str:
    """Views ``sizes`` and ``counts`` of token presence in the labelled rows."""
    return f"""
        sizes as (select count(*) filter (where label = 1) as n1, count(*) filter (where label = 0) as n0
            from {source} where {where}),
        {_tokens("seen", f"(select * from {source} where {where})", "doc_id", "text", "label,")},
        counts as (select token, count(*) filter (where label = 1) as c1, count(*) filter (where label = 0) as c0
            from seen group by token having count(*) >= 5)"""


def _weight(a: float) -> str:
    return (f"ln((c1 + {a}::double) / (n1 + {2 * a}::double))"
            f" - ln((c0 + {a}::double) / (n0 + {2 * a}::double))")


def _scored_tokens(source: str, row_id: str, text: str, name: str = "z", a: float = 1.0) -> str:
    """A view of summed weights per row, zero for rows without known tokens."""
    return f"""
        {_tokens(f"{name}_tokens", source, row_id, text)},
        {name} as (select {row_id} as doc_id, round(coalesce(sum(w), 0)
                + (select ln((n1 + {a}::double) / (n0 + {a}::double)) from sizes), 9) as logit
            from {source} d left join (
                select t.doc_id as id, {_weight(a)} as w from {name}_tokens t join counts using (token), sizes
            ) on id = {row_id}
            group by {row_id})"""


_P = "case when logit >= 0 then 1 / (1 + exp(-logit)) else exp(logit) / (1 + exp(logit)) end"
_NAME = "case when logit > 0 then 'positive' else 'negative' end"


def _metric_columns(prefix: str = "") -> str:
    return f"""
        round((tp + tn) / (tp + fp + fn + tn)::double, 6) as {prefix}accuracy,
        round(coalesce(tp / nullif(tp + fp, 0)::double, 0), 6) as {prefix}precision,
        round(coalesce(tp / nullif(tp + fn, 0)::double, 0), 6) as {prefix}recall,
        round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::double, 0), 6) as {prefix}f1"""


def _outcomes(prediction: str) -> str:
    return ", ".join(
        f"count(*) filter (where label = {l} and {prediction} = {p}) as {name}"
        for name, l, p in (("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0), ("tn", 0, 0)))


def _summary(source: str, by: str = "") -> str:
    group, comma = (f"group by {by}", f"{by},") if by else ("", "")
    part = f"{by}, prediction" if by else "prediction"

    def top(name: str) -> str:
        return (f"coalesce(string_agg(review_clean, chr(10) order by upload_id)"
                f" filter (where prediction = '{name}' and rn <= 5), '') as top_{name}_reviews")

    return f"""
        select {comma} count(*) as total_reviews,
            count(*) filter (where prediction = 'positive') as positive_reviews,
            count(*) filter (where prediction = 'negative') as negative_reviews,
            count(*) filter (where prediction = 'neutral') as neutral_reviews,
            round(sum(length(review_clean)) / count(review_clean)::double, 2) as average_review_length,
            count(*) filter (where short_review) as short_reviews_flagged,
            {top("positive")}, {top("negative")}
        from (select *, row_number() over (partition by {part} order by upload_id) as rn from {source})
        {group}"""


_CLEAN_COUNTS = r"""
    select count(*) as original_rows,
        count(*) filter (where review_clean is null or review_clean = '') as dropped_null_or_empty,
        count(*) filter (where regexp_matches(review_clean, '^[0-9\s]+$')) as dropped_numeric_only,
        (select count(*) from cleaned where short_review) as short_reviews_flagged,
        (select count(*) from cleaned) as retained_clean_reviews
    from trimmed"""

_CANDIDATES = _sql(
    "judged",
    """select smoothing, """ + _metric_columns() + """ from (
        select smoothing, """ + _outcomes("cast(logit > 0 as int)") + """
        from cand join judged using (doc_id) group by smoothing)""",
    _counts("judged", "training") + ", "
    + ", ".join(_scored_tokens("(select * from judged where chosen_on)", "doc_id", "text", f"z{i}", a)
                for i, a in enumerate(GRID))
    + ", cand as (" + " union all ".join(
        f"select {a}::double as smoothing, doc_id, logit from z{i}" for i, a in enumerate(GRID)) + ")")



def _epoch_views(features: int = 64, rate: float = 1.0) -> str:
    """Two epochs of two mini-batches as views: weights ``w1`` to ``w4``, scores ``s1`` and ``s2``, and ``best``."""
    number = "cast('0x' || substr(md5({}), 1, 8) as bigint)"
    views = [
        _tokens("seen", "judged", "doc_id", "text"),
        f"""x as materialized (select distinct doc_id, {number.format("token")} % {features} as f from seen
            union all select doc_id, {features} from judged)""",
        f"dealt as (select *, {number.format("'42:' || cast(doc_id as varchar)")} % 2 as batch from judged where training)",
        f"w0 as (select f, 0::double as w from range({features + 1}) r(f))"]
    for k, batch in enumerate((1, 0, 0, 1), 1):  # epoch + step, modulo 2
        views += [
            f"""p{k} as materialized (select doc_id, label, 1 / (1 + exp(-sum(w))) as p
                from dealt join x using (doc_id) join w{k - 1} using (f) where batch = {batch} group by doc_id, label)""",
            f"g{k} as (select f, round(sum(p - label), 9) as g from x join p{k} using (doc_id) group by f)",
            f"""w{k} as materialized (select f, round(w - {rate}::double * (coalesce(g, 0) / n), 9) as w
                from w{k - 1} left join g{k} using (f), (select cast(count(*) as double) as n from p{k}))"""]
    for epoch in (1, 2):
        views.append(f"""s{epoch} as materialized (select label, round(sum(w), 9) as logit
            from judged join x using (doc_id) join w{2 * epoch} using (f) where chosen_on group by doc_id, label)""")
    f1 = "count(*) filter (where label = 1 and logit > 0) * 2 / (count(*) filter (where label = 1) + count(*) filter (where logit > 0))::double"
    views.append(f"""best as (select epoch from (select 1 as epoch, {f1} as f1 from s1 union all select 2, {f1} from s2)
        order by coalesce(f1, 0) desc, epoch limit 1)""")
    return ", ".join(views)


_EPOCHS = _epoch_views()


def _epoch_metrics(epoch: int) -> str:
    return f"""select {epoch} as epoch, round(log_loss, 6) as log_loss, {_metric_columns()} from (
        select avg(-ln(greatest(case when label = 1 then {_P} else 1 - {_P} end, 1e-15::double))) as log_loss,
            {_outcomes("cast(logit > 0 as int)")} from s{epoch})"""


_NB_ALL = _counts("judged") + ", " + _scored_tokens("documents", "doc_id", "text")

def _document(name: str, tested: str) -> str:
    """The evaluation document of scored rows: doc_id, text, label, logit and p."""
    return f"""
        select '{name}' as model_name, (select round(avg(-ln(greatest(
                case when label = 1 then p else 1 - p end, 1e-15::double))), 6) from {tested}) as eval_loss,
            {_metric_columns("eval_")},
            tp + fn as actual_positive, fp + tn as actual_negative,
            tp + fp as predicted_positive, fn + tn as predicted_negative,
            (select coalesce(string_agg(text, chr(10) order by p desc, doc_id), '') from (select * from {tested}
                where logit > 0 order by p desc, doc_id limit 5)) as top_predicted_positive,
            (select coalesce(string_agg(text, chr(10) order by 1 - p desc, doc_id), '') from (select * from {tested}
                where logit <= 0 order by 1 - p desc, doc_id limit 5)) as top_predicted_negative
        from (select {_outcomes("cast(logit > 0 as int)")} from {tested})"""


_F1 = """coalesce(count(*) filter (where label = 1 and logit > 0) * 2 / nullif(
    count(*) filter (where label = 1) + count(*) filter (where logit > 0), 0)::double, 0)"""
_WHOLE_CHAIN = _sql(
    "chain_judged", _document("naive-bayes, stamped", "tested"),
    _counts("chain_judged", "training") + ", "
    + ", ".join(_scored_tokens("(select * from chain_judged where not training)", "doc_id", "text", f"z{i}", a)
                for i, a in enumerate(GRID))
    + ", cand as materialized (select * from (" + " union all ".join(
        f"select {a}::double as smoothing, doc_id, logit from z{i}" for i, a in enumerate(GRID))
    + f""") join chain_judged using (doc_id)),
    chosen as (select smoothing from cand where chosen_on group by smoothing order by {_F1} desc, smoothing limit 1),
    tested as (select *, {_P} as p from cand where judged_on and smoothing = (select smoothing from chosen))""")

_FITS = {
    "boolean": "lower(v) in ('true', 'false')",
    "bigint": r"regexp_matches(v, '^[+-]?(0|[1-9]\d*)$') and try_cast(v as bigint) is not null",
    "double": r"regexp_matches(v, '^[+-]?(0|[1-9]\d*)(\.\d+)?([eE][+-]?\d+)?$') and try_cast(v as double) is not null",
    "date": r"regexp_matches(v, '^\d{4}-\d\d-\d\d$') and try_cast(v as date) is not null",
    "timestamp": r"regexp_matches(v, '^\d{4}-\d\d-\d\d[ T]\d\d:\d\d(:\d\d)?$') and try_cast(v as timestamp) is not null",
}
_INFERRED = f"""
    with mixed as ({adapters.select_sql(adapters.MIXED, "orders")})
    select name, case when count(v) = 0 then 'string' {" ".join(
        f"when bool_and({fits}) filter (v is not null) then '{kind}'" for kind, fits in _FITS.items())} else 'string' end as type
    from ({" union all ".join(f"select '{c}' as name, {c} as v from mixed" for c in adapters.MIXED)})
    group by name"""


def _subwords(length: int = 512) -> str:
    """Greedy cutting of the distinct words, one piece of each per step."""
    file = registered.subword_vocabulary()
    return f"""
        with recursive model as (
            select model.vocab as vocab from read_json('{file}', columns = {{model: 'struct(vocab map(varchar, integer))'}})),
        pieces as (select unnest(map_keys(vocab)) as piece, unnest(map_values(vocab)) as id from model),
        words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as place from (
            select doc_id, regexp_extract_all(lower(text), '[\\p{{L}}]+|[\\p{{N}}]|[^ \\t-\\r\\p{{L}}\\p{{N}}]+') as w from documents)),
        cuts(word, pos, ids) as (
            select distinct word, cast(1 as bigint), cast([] as integer[]) from words
            union all
            select word, pos + max(n), list_append(ids, arg_max(id, n)) from (
                select word, pos, ids, n, substr(word, pos, n) || case when pos + n > length(word) then '</w>' else '' end as piece
                from (select *, unnest(range(1, least(length(word) - pos + 1, 32) + 1)) as n from cuts where pos <= length(word)))
            join pieces using (piece) group by word, pos, ids),
        whole as (select word, coalesce(any_value(ids) filter (pos > length(word)), [49407]) as ids from cuts group by word),
        texts as (select doc_id, flatten(list(ids order by place)) as ids from words join whole using (word) group by doc_id),
        used as (select doc_id, coalesce(len(ids), 0) as n_tokens,
            [49406] || list_slice(coalesce(ids, []), 1, {length - 2}) || [49407] as kept
            from documents left join texts using (doc_id))
        select doc_id, n_tokens, cast(len(kept) as int) as n_used,
            md5(array_to_string(list_resize(kept, {length}, 0), ',')) as ids_md5 from used"""


_AUDIT = _sql("uniq", """
    select (select count(*) from reviews) as original_rows,
        (select count(*) from reviews) - (select count(*) from normal) as dropped_empty,
        (select count(*) from normal) - count(*) as dropped_duplicates, count(*) as retained_rows
    from uniq""")

ORACLE: dict[str, str] = {
    "category_sentiment": _sql("uniq", """
        select product_category, count(*) as n_reviews,
            count(*) filter (where star_rating > 3) as n_positive,
            count(*) filter (where star_rating < 3) as n_negative,
            round(avg(length(review_body)), 2) as avg_length
        from uniq where star_rating is not null and star_rating <> 3 group by product_category"""),
    "review_projection": _sql("reviews", """
        select * from reviews where review_body is not null and review_body <> ''"""),
    "rating_normalize": _sql("rated", "select review_id, star_rating from rated"),
    "rating_repair": _sql("reviews", """
        select review_id, case when d < 0 then null when d > 5 then 5.0::double else d end as star_rating
        from (select review_id, try_cast(star_rating as double) as d from reviews)"""),
    "rating_range_audit": _sql("reviews", """
        select count(*) as n_rows, count(*) filter (where f < 0) as below_zero,
            count(*) filter (where f > 5) as above_five, count(*) filter (where f is null) as null_before
        from (select try_cast(star_rating as float) as f from reviews)"""),
    "text_normalize": _sql("normal", "select review_id, review_body, review_headline from normal"),
    "line_break_strip": _sql("reviews", r"""
        select review_id, regexp_replace(review_body, '[\r\n]+', ' ', 'g') as review_body from reviews"""),
    "text_dedup": _sql("uniq reviews", """
        select review_id, product_category, r.star_rating, u.review_body, u.review_headline
        from uniq u join reviews r using (review_id, product_category)"""),
    "preprocess_audit": _AUDIT,
    "observed_audit": _AUDIT,
    "required_text": _sql("reviews", """
        select review_id, cast(length(review_body) as int) as review_length from reviews
        where review_body is not null and review_headline is not null"""),
    "drop_incomplete": _sql("rated", """
        select review_id, review_body as text, case when star_rating > 3 then 1 else 0 end as label
        from rated where review_body is not null and star_rating is not null and star_rating <> 3"""),
    "length_stats": _sql("valid", "select round(avg(review_length), 6) as avg_review_length from valid"),
    "anomaly_flags": _sql("valid", """
        select review_id, cast(star_rating as double) as star_rating, cast(review_length as int) as review_length,
            review_length < 10 or review_length > 1.5::double * (select avg(review_length) from valid)
                as anomaly_flag
        from valid"""),
    "binary_labels": _sql("rated", """
        select review_id, case when star_rating > 3 then 1 else 0 end as label
        from rated where star_rating is not null and star_rating <> 3"""),
    "class_distribution": _sql("rated", """
        select case when star_rating > 3 then 1 else 0 end as label, count(*) as n
        from rated where star_rating is not null and star_rating <> 3 group by 1"""),
    "hash_split": _sql("with_text", """
        select review_id, star_rating, case when b < 80 then 'train' when b < 90 then 'test' else 'serve' end as split
        from (select *, cast('0x' || substr(md5('42:' || cast(review_id as varchar)), 1, 8) as bigint) % 100 as b
            from with_text)"""),
    "balanced_sample": _sql("sample", "select review_id, label, review_body from sample"),
    "balanced_size": _sql("size", "select per_class from size"),
    "per_class_sample": _sql("scored", f"""
        select doc_id, label from (select doc_id, label, row_number() over (partition by label
            order by md5('42:' || cast(doc_id as varchar)), doc_id) as rn from scored)
        where rn <= {SAMPLE_ROWS}"""),
    "holdout_remaining": _sql("remaining", "select review_id, label from remaining"),
    "sampling_summary": _sql("remaining", """
        select count(*) filter (where star_rating is null or star_rating = 3) as dropped_3_star_reviews,
            count(*) filter (where star_rating is null) as dropped_unrated,
            count(*) filter (where star_rating = 3) as dropped_neutral,
            (select count(*) from labelled where label = 1) as n_positive,
            (select count(*) from labelled where label = 0) as n_negative,
            (select count(*) from sample where label = 1) as sampled_positive,
            (select count(*) from sample where label = 0) as sampled_negative,
            (select count(*) from remaining) as remaining_after_sampling
        from with_text"""),
    "upload_clean": _sql("cleaned", "select * from cleaned"),
    "short_reviews": _sql("flagged", "select upload_id, short_review from flagged"),
    "upload_clean_summary": _sql("cleaned", _CLEAN_COUNTS),
    "label_names": """
        select doc_id, case quality + toxic when 0 then 'negative' when 1 then 'positive' else 'unknown' end
            as prediction
        from labels""",
    "sentiment_distribution": _sql("scored", """
        select case prediction when 1 then 'positive' else 'negative' end as prediction, count(*) as n_reviews
        from scored group by 1"""),
    "length_histogram": _sql("cleaned", """
        select cast(bin as int) as bin, round(lo + (hi - lo) / 30.0::double * bin, 6) as from_length,
            round(lo + (hi - lo) / 30.0::double * (bin + 1), 6) as to_length, coalesce(n, 0) as n_reviews
        from range(30) r(bin) cross join span left join (
            select least(cast(floor((length(review_clean) - lo) * 30.0::double / (hi - lo)) as int), 29) as bin,
                count(*) as n
            from cleaned, span group by 1) using (bin)""",
        """span as (select cast(min(length(review_clean)) as double) as lo,
            cast(max(length(review_clean)) as double) as hi from cleaned)"""),
    "sentiment_summary": _sql("served", _summary("served")),
    "user_sentiment_summary": _sql("served", _summary("served", "user_name")),
    "first_k_per_class": _sql("served", """
        select prediction, upload_id, review_clean, cast(rn as int) as rank from (
            select *, row_number() over (partition by prediction order by upload_id) as rn from served)
        where rn <= 5 and prediction <> 'unknown'"""),
    "top_confident": _sql("scored", """
        select prediction, cast(rn as int) as rank, doc_id, round(confidence, 6) as confidence from (
            select *, row_number() over (partition by prediction order by confidence desc, doc_id) as rn from (
                select *, case when prediction = 1 then positive_score else negative_score end as confidence
                from scored))
        where rn <= 5"""),
    "token_counts": "with " + _tokens("t", "documents", "doc_id", "text") + """
        select token, count(*) as n_docs from t group by token""",
    **({"subword_ids": _subwords()} if "subword_ids" in registered.QUERIES else {}),
    "nb_weights": _sql("judged", f"""
        select token, c1 as positive_docs, c0 as negative_docs, round({_weight(1.0)}, 6) as weight
        from counts, sizes""", _counts("judged")),
    "nb_scores": _sql("judged", f"""
        select doc_id, round(logit, 6) as logit, round({_P}, 6) as positive_score,
            round(1 - {_P}, 6) as negative_score, cast(logit > 0 as int) as prediction_label,
            {_NAME} as prediction
        from z""", _NB_ALL),
    "model_scoring_map": _sql("judged", f"""
        select doc_id, lang, source, round({_P}, 6) as positive_score,
            round(1 - {_P}, 6) as negative_score, cast(logit > 0 as int) as prediction_label,
            {_NAME} as prediction
        from z join documents using (doc_id)""", _NB_ALL),
    "upload_scores": _sql("judged cleaned", f"""
        select upload_id, user_name, review_clean, short_review, round({_P}, 6) as positive_score,
            round(1 - {_P}, 6) as negative_score, cast(logit > 0 as int) as prediction_label,
            {_NAME} as prediction
        from cleaned join z on z.doc_id = upload_id""",
        _counts("judged") + ", " + _scored_tokens("cleaned", "upload_id", "review_clean")),
    "confusion_counts": _sql("scored", """
        select label, prediction, count(*) as n from scored group by label, prediction"""),
    "class_summary": _sql("scored", """
        select count(*) filter (where label = 1) as actual_positive,
            count(*) filter (where label = 0) as actual_negative,
            count(*) filter (where prediction = 1) as predicted_positive,
            count(*) filter (where prediction = 0) as predicted_negative
        from scored"""),
    "classification_metrics": _sql("scored", f"""
        select {_metric_columns()} from (select {_outcomes("prediction")} from scored)"""),
    "log_loss": _sql("scored", """
        select round(avg(-ln(case when label = 1 then positive_score else 1 - positive_score end)), 6) as log_loss
        from scored"""),
    "candidate_models": _CANDIDATES,
    "best_model": f"select * from ({_CANDIDATES}) order by f1 desc, smoothing limit 1",
    "model_evaluation": _sql("judged", _document("naive-bayes", "tested"),
        _counts("judged", "training") + ", "
        + _scored_tokens("(select * from judged where judged_on)", "doc_id", "text")
        + f""", tested as (select *, {_P} as p from judged join z using (doc_id) where judged_on)"""),
    "whole_chain": _WHOLE_CHAIN,
    "csv_roundtrip": _sql("uploads", "select * from uploads"),
    "training_csv_roundtrip": _sql("sample", "select review_body, label from sample"),
    "partitioned_roundtrip": _sql("cleaned", "select upload_id, user_name, review_clean from cleaned"),
    "split_roundtrip": _sql("with_text", """
        select case when b < 80 then 'train' when b < 90 then 'test' else 'serve' end as split,
            count(*) as n_rows, cast(sum(star_rating) as bigint) as total_rating
        from (select *, cast('0x' || substr(md5('42:' || cast(review_id as varchar)), 1, 8) as bigint) % 100 as b
            from with_text)
        group by 1"""),
    "metrics_json_roundtrip": _sql("cleaned", _CLEAN_COUNTS),
    "stream_upload_clean": _sql("cleaned", """
        select * replace (coalesce(user_name, 'guest') as user_name) from cleaned"""),
    "stream_turn_clean": _sql("turns_trimmed", r"""
        select *, length(review_clean) < 30 or len(list_filter(
            string_split_regex(review_clean, '\s+'), lambda x: x <> '')) < 5 as short_review
        from turns_trimmed
        where length(review_clean) > 0 and not regexp_matches(review_clean, '^[0-9\s]+$')"""),
    "stream_upload_summary": _sql("judged cleaned", _summary("predicted", "user_name"),
        _counts("judged") + ", " + _scored_tokens("cleaned", "upload_id", "review_clean")
        + f", predicted as (select c.* replace (coalesce(user_name, 'guest') as user_name), {_NAME} as prediction"
        + " from cleaned c join z on z.doc_id = c.upload_id)"),
    "random_split_sizes": _sql("reviews", """
        select count(*) as n_rows, cast(0 as bigint) as n_in_two_parts, true as sizes_as_asked from reviews"""),
    "epoch_metrics": _sql("judged", " union all ".join(_epoch_metrics(e) for e in (1, 2)), _EPOCHS),
    "epoch_weights": _sql("judged", """
        select 1 as epoch, f as feature, round(w, 6) as weight from w2 where w <> 0
        union all select 2, f, round(w, 6) from w4 where w <> 0""", _EPOCHS),
    "best_epoch": _sql("judged", f"""
        select * from ({" union all ".join(_epoch_metrics(e) for e in (1, 2))})
        where epoch = (select epoch from best)""", _EPOCHS),
    "lr_confusion": _sql("judged", """
        select label, cast(logit > 0 as int) as prediction, count(*) as n from (
            select doc_id, label, round(sum(w), 9) as logit from x join judged using (doc_id) join (
                select f, w from w2 where (select epoch from best) = 1
                union all select f, w from w4 where (select epoch from best) = 2) using (f)
            where judged_on group by doc_id, label)
        group by 1, 2""", _EPOCHS),
    "training_csv_order": _sql("sample", """
        select row_number() over (order by md5('43:' || cast(review_id as varchar)), review_id) - 1 as position,
            md5(review_body) as text_md5
        from sample"""),
    "inferred_types": _INFERRED,
    "user_bucket_read": _sql("cleaned", """
        select user_name, count(*) as n_rows, cast(sum(upload_id) as bigint) as ids from kept group by user_name
        union all select 'only user3', 1, upload_id from kept where user_name = 'user3'""",
        """kept as (select * from cleaned
            where coalesce(user_name, '') not in ('user3', 'user5') or upload_id % 2 = 1)"""),
    "user_partition_read": _sql("cleaned", """
        select upload_id, user_name, review_clean from cleaned where user_name = 'user3'"""),
    "upload_times": f"""
        select doc_id, strftime(try_strptime(regexp_extract(name, '^[0-9]{{14}}'), '%Y%m%d%H%M%S'), '%Y-%m-%d %H:%M:%S')
            as uploaded_at
        from (select doc_id, {adapters.FILE_NAME} as name from documents)""",
    "dashboard": _sql("served", """
        select 'summary' as name, 'total_reviews' as entry, count(*) as value from served
        union all select 'summary', 'short_reviews_flagged', count(*) filter (where short_review) from served
        union all select 'distribution', prediction, count(*) from served group by prediction
        union all select 'histogram', cast(r.bin as varchar), coalesce(n, 0) from range(30) r(bin) left join (
            select least(cast(floor((length(review_clean) - lo) * 30.0::double / (hi - lo)) as int), 29) as bin,
                count(*) as n from served, span group by 1) b on b.bin = r.bin
        union all select 'top_reviews', prediction || '-' || cast(rn as varchar), upload_id from (
            select *, row_number() over (partition by prediction order by upload_id) as rn from served)
            where rn <= 5 and prediction <> 'unknown'""",
        """span as (select cast(min(length(review_clean)) as double) as lo,
            cast(max(length(review_clean)) as double) as hi from served)"""),
}
