"""DuckDB twins of the registered queries (the correctness oracle).

Each string runs on DuckDB over the raw driver tables; the views of the
data model are restated as CTEs in DuckDB's dialect.  They are written
independently of the DataFrame code (fold by fold, no subtraction tricks)
so that agreement means something.
"""

APP_EVENTS = """app_events as (
  select event_id, user_id device_id, cast(json_extract_string(props,'$.k') as int) app_id,
    cast(event_type<>'error' as int) is_installed,
    cast(event_type in ('click','purchase') as int) is_active, cast(day(ts) as int) "date",
    array_to_string(list_transform(range(0, cast(json_extract_string(props,'$.k') as int)%5+1),
      lambda i: 't'||cast((cast(json_extract_string(props,'$.k') as int)*7+i)%40 as varchar)),',') tag_list
  from events)"""

DEVICES = """devices as (
  select distinct c_custkey device_id, c_nationkey phone_brand,
    cast(length(c_mktsegment)*10 + c_custkey%10 as int) device_model,
    case when c_custkey%5<>0 then cast(c_acctbal>=4500 as int) end gender,
    case when c_custkey%5<>0 then cast(18+c_custkey%40 as int) end age,
    cast(c_custkey%5<>0 as int) is_train
  from customer)"""

RETAIL_EVENTS = """app_events as (
  select l.l_orderkey event_id, o.o_custkey device_id, l.l_partkey app_id,
    cast(l.l_linestatus='O' as int) is_installed, cast(l.l_returnflag='A' as int) is_active,
    cast(day(l.l_shipdate) as int) "date", concat_ws(',', p.p_type, p.p_brand, p.p_name) tag_list
  from lineitem l join orders o on l.l_orderkey=o.o_orderkey
  left join part p on l.l_partkey=p.p_partkey)"""

FOLDS = """folds as (
  select device_id, cast((row_number() over (order by gender,
    md5(concat(cast(device_id as varchar), ':2021')))-1)%5 as int) fold
  from devices where is_train=1 and gender is not null)"""

AGE_FOLDS = """age_folds as (
  select device_id, cast((row_number() over (order by age,
    md5(concat(cast(device_id as varchar), ':2021')))-1)%5 as int) fold
  from devices where is_train=1 and age is not null)"""


def _with(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


EVENT_AGGS = """ev_aggs as (
  select device_id,
    cast(count(event_id) as bigint) event_id_count,
    cast(count(distinct event_id) as bigint) event_id_nunique,
    cast(count(distinct app_id) as bigint) app_id_nunique,
    cast(coalesce(sum(is_installed),0) as bigint) is_installed_sum,
    avg(is_active) is_active_mean,
    cast(coalesce(sum(is_active),0) as bigint) is_active_sum,
    max("date") date_max, min("date") date_min,
    cast(count(distinct "date") as bigint) date_nunique,
    avg(length(tag_list)-length(replace(tag_list,',',''))+1) tag_list_len_mean,
    stddev_samp(length(tag_list)-length(replace(tag_list,',',''))+1) tag_list_len_std
  from app_events where device_id is not null group by device_id)"""

TRI_DAY = """tri as (
  select device_id, cast(count(*) as bigint) tri_day_event_cnt
  from app_events where "date" between 1 and 3 and device_id is not null group by device_id)"""

APP_CNT = """app_cnt as (
  select device_id, app_id, count(*) app_cnt from app_events
  where device_id is not null group by device_id, app_id)"""

MAX_APP = """max_app as (
  select device_id, app_id max_app_id from (
    select device_id, app_id, row_number() over (partition by device_id order by app_cnt desc, app_id) rn
    from app_cnt where app_id is not null) where rn=1)"""

TOP_APPS = """pop as (
  select app_id, count(device_id) app_pop from app_events where app_id is not null group by app_id),
ranked as (select app_id, row_number() over (order by app_pop desc, app_id) app_rank from pop),
top_cnt as (
  select e.device_id,
    cast(sum(case when r.app_rank<=100 then 1 else 0 end) as bigint) top100_app_cnt,
    cast(sum(case when r.app_rank<=50 then 1 else 0 end) as bigint) top50_app_cnt,
    cast(sum(case when r.app_rank<=10 then 1 else 0 end) as bigint) top10_app_cnt
  from app_events e left join ranked r on e.app_id=r.app_id
  where e.device_id is not null group by e.device_id)"""


def _enc(feat: str, label: str = "gender", folds: str = "folds") -> str:
    return f"""enc_{feat} as (
  select d.device_id,
    coalesce(case when d.is_train=1 then
      (select avg(t.{label}) from devices t join {folds} tf on t.device_id=tf.device_id
        where t.{feat}=d.{feat} and tf.fold<>f.fold)
    else (select avg(t.{label}) from devices t where t.is_train=1 and t.{feat}=d.{feat}) end,
    (select avg({label}) from devices where is_train=1)) {feat}_{label}_kfold_mean
  from devices d left join {folds} f on d.device_id=f.device_id)"""


DEVICE_FEATURE_SELECT = """select d.device_id, d.phone_brand, d.device_model, d.gender, d.age, d.is_train,
  a.event_id_count, a.event_id_nunique, a.app_id_nunique, a.is_installed_sum,
  round(a.is_active_mean,6) is_active_mean, a.is_active_sum, a.date_max, a.date_min, a.date_nunique,
  round(a.tag_list_len_mean,6) tag_list_len_mean, round(a.tag_list_len_std,6) tag_list_len_std,
  round(a.event_id_count / nullif(a.event_id_nunique,0),6) event_id_count_nunique_ratio,
  round(a.tag_list_len_mean / nullif(a.tag_list_len_std,0),6) tag_list_len_mean_div_std"""


def device_aggregates_sql(events_cte: str = APP_EVENTS) -> str:
    return _with(events_cte, DEVICES, EVENT_AGGS) + DEVICE_FEATURE_SELECT + """
from devices d left join ev_aggs a on d.device_id=a.device_id"""


def device_features_sql(events_cte: str = APP_EVENTS) -> str:
    return (_with(events_cte, DEVICES, EVENT_AGGS, TRI_DAY, APP_CNT, MAX_APP, TOP_APPS, FOLDS,
                  _enc("phone_brand"), _enc("device_model"))
            + DEVICE_FEATURE_SELECT + """,
  t.tri_day_event_cnt, m.max_app_id, c.top100_app_cnt, c.top50_app_cnt, c.top10_app_cnt,
  round(eb.phone_brand_gender_kfold_mean,6) phone_brand_gender_kfold_mean,
  round(em.device_model_gender_kfold_mean,6) device_model_gender_kfold_mean
from devices d left join ev_aggs a on d.device_id=a.device_id
left join tri t on d.device_id=t.device_id
left join max_app m on d.device_id=m.device_id
left join top_cnt c on d.device_id=c.device_id
left join enc_phone_brand eb on d.device_id=eb.device_id
left join enc_device_model em on d.device_id=em.device_id""")


def tri_day_sql() -> str:
    return _with(APP_EVENTS, DEVICES, TRI_DAY) + """select d.device_id, t.tri_day_event_cnt
from devices d left join tri t on d.device_id=t.device_id"""


def max_app_sql(events_cte: str = APP_EVENTS) -> str:
    return _with(events_cte, DEVICES, APP_CNT, MAX_APP) + """select d.device_id, m.max_app_id
from devices d left join max_app m on d.device_id=m.device_id"""


def top_app_sql(events_cte: str = APP_EVENTS) -> str:
    return _with(events_cte, DEVICES, APP_CNT, MAX_APP, TOP_APPS) + """select d.device_id, m.max_app_id,
  c.top100_app_cnt, c.top50_app_cnt, c.top10_app_cnt
from devices d left join max_app m on d.device_id=m.device_id
left join top_cnt c on d.device_id=c.device_id"""


def folds_sql() -> str:
    return _with(DEVICES, FOLDS) + "select device_id, fold from folds"


def age_folds_sql() -> str:
    return _with(DEVICES, AGE_FOLDS) + "select device_id, fold from age_folds"


def target_encoding_sql() -> str:
    return _with(DEVICES, FOLDS, _enc("phone_brand"), _enc("device_model")) + """select d.device_id,
  round(eb.phone_brand_gender_kfold_mean,6) phone_brand_gender_kfold_mean,
  round(em.device_model_gender_kfold_mean,6) device_model_gender_kfold_mean
from devices d left join enc_phone_brand eb on d.device_id=eb.device_id
left join enc_device_model em on d.device_id=em.device_id"""


def retail_features_sql() -> str:
    return (_with(RETAIL_EVENTS, DEVICES, EVENT_AGGS, TRI_DAY, APP_CNT, MAX_APP, TOP_APPS)
            + DEVICE_FEATURE_SELECT + """,
  t.tri_day_event_cnt, m.max_app_id, c.top100_app_cnt, c.top50_app_cnt, c.top10_app_cnt
from devices d left join ev_aggs a on d.device_id=a.device_id
left join tri t on d.device_id=t.device_id
left join max_app m on d.device_id=m.device_id
left join top_cnt c on d.device_id=c.device_id""")


TRIPLES = """tri as (
  select device_id, app_id, tag_list, min("date") first_date from app_events
  where device_id is not null group by device_id, app_id, tag_list)"""


def app_event_sequence_sql() -> str:
    return _with(APP_EVENTS) + """select device_id,
  row_number() over (partition by device_id order by event_id, app_id) pos, app_id
from app_events where device_id is not null"""


def triples_sql() -> str:
    return _with(APP_EVENTS, TRIPLES) + "select device_id, app_id, tag_list, first_date from tri"


def triple_tfidf_sql(column: str) -> str:
    return _with(APP_EVENTS, DEVICES, TRIPLES, f"""tok as (
  select device_id, unnest(regexp_extract_all(lower(cast({column} as varchar)), '\\b\\w\\w+\\b')) term from tri)""",
                 """tf as (select device_id, term, count(*) tf from tok group by device_id, term)""",
                 """nd as (select count(distinct device_id) n from devices)""",
                 """dfs as (select term, count(*) df from tf group by term)""",
                 """w as (select tf.device_id, tf.term, tf.tf, tf.tf*(ln((1+nd.n)/(1+dfs.df))+1) w
  from tf join dfs on tf.term=dfs.term cross join nd)""") + """select device_id, term, cast(tf as bigint) tf,
  round(w / sqrt(sum(w*w) over (partition by device_id)), 6) tfidf from w"""


def active_ngram_sql() -> str:
    return _with(APP_EVENTS, DEVICES, """act as (
  select device_id, cast(app_id as varchar) tok,
    row_number() over (partition by device_id order by "date", event_id, app_id) pos
  from app_events where is_active=1 and device_id is not null and length(cast(app_id as varchar))>=2)""",
                 """g as (
  select device_id, tok term from act
  union all select a.device_id, a.tok||' '||b.tok from act a join act b on a.device_id=b.device_id and b.pos=a.pos+1
  union all select a.device_id, a.tok||' '||b.tok||' '||c.tok from act a
    join act b on a.device_id=b.device_id and b.pos=a.pos+1
    join act c on a.device_id=c.device_id and c.pos=a.pos+2
  union all select distinct d.device_id, 'nan' from devices d
    where not exists (select 1 from app_events e where e.device_id=d.device_id and e.is_active=1))""") + \
        "select device_id, term, cast(count(*) as bigint) tf from g group by device_id, term"


SEQ = """seq as (
  select device_id, cast(app_id as varchar) token,
    row_number() over (partition by device_id order by first_date, app_id, tag_list) pos from tri)""" 

RANKS = """ranks as (
  select token, count(*) cnt, row_number() over (order by count(*) desc, token) "rank"
  from seq group by token)"""


def token_rank_sql() -> str:
    return _with(APP_EVENTS, TRIPLES, SEQ, RANKS) + "select token, cast(cnt as bigint) cnt, cast(\"rank\" as bigint) \"rank\" from ranks"


def padded_sequence_sql() -> str:
    return _with(APP_EVENTS, TRIPLES, SEQ, RANKS, """coded as (
  select s.device_id, s.pos, r."rank", count(*) over (partition by s.device_id) n
  from seq s join ranks r on s.token=r.token)""") + """select device_id,
  array_to_string(list_concat(list_transform(range(greatest(50-count(*),0)), lambda x: 0),
    list(cast("rank" as bigint) order by pos)), ',') seq_text
from coded where pos > n - 50 group by device_id"""


def _tfidf_blocks(src: str, name: str, i0: int) -> list[str]:
    """count + tf-idf blocks of term counts table ``tf_{name}`` (n = all devices)."""
    return [
        f"""idf_{name} as (select term, ln((1+(select count(*) from devices))/(1+count(*)))+1 idf
  from tf_{name} group by term)""",
        f"""w_{name} as (select t.device_id, t.term, t.tf*i.idf w from tf_{name} t join idf_{name} i on t.term=i.term)""",
        f"""mat_{name} as (
  select device_id, '{i0:02d}c{name}|'||term col, cast(tf as double) "value" from tf_{name}
  union all select device_id, '{i0+1:02d}t{name}|'||term, w / sqrt(sum(w*w) over (partition by device_id)) from w_{name})""",
    ]


APP_TAG_MATRIX = [
    """tf_app as (select device_id, term, count(*) tf from (
  select device_id, unnest(regexp_extract_all(cast(app_id as varchar), '\\b\\w\\w+\\b')) term from tri) group by all)""",
    """tf_tag as (select device_id, term, count(*) tf from (
  select device_id, unnest(regexp_extract_all(lower(tag_list), '\\b\\w\\w+\\b')) term from tri) group by all)""",
    *_tfidf_blocks("tri", "app", 0), *_tfidf_blocks("tri", "tag", 2),
    """mat as (select * from mat_app union all select * from mat_tag)""",
]

ACTIVE_MATRIX = [
    """act as (
  select device_id, cast(app_id as varchar) tok,
    row_number() over (partition by device_id order by "date", event_id, app_id) pos
  from app_events where is_active=1 and device_id is not null and length(cast(app_id as varchar))>=2)""",
    """tf_act as (select device_id, term, count(*) tf from (
  select device_id, tok term from act
  union all select a.device_id, a.tok||' '||b.tok from act a join act b on a.device_id=b.device_id and b.pos=a.pos+1
  union all select a.device_id, a.tok||' '||b.tok||' '||c.tok from act a
    join act b on a.device_id=b.device_id and b.pos=a.pos+1
    join act c on a.device_id=c.device_id and c.pos=a.pos+2
  union all select distinct d.device_id, 'nan' from devices d
    where not exists (select 1 from app_events e where e.device_id=d.device_id and e.is_active=1)) group by all)""",
    *_tfidf_blocks("act", "act", 0),
    """mat as (select * from mat_act)""",
]

GENDER_NB_ROWS = """nbrows as (select d.device_id, d.gender label, case when d.is_train=1 then f.fold end fold
  from devices d left join folds f on d.device_id=f.device_id)"""

NB_ROWS = [
    """ms as (select cast(range as int) m from range(5))""",
    """vw as (select count(distinct col) V from mat)""",
    """ncls as (select ms.m, r.label c, count(*) n_c from ms join nbrows r on r.fold is not null and r.fold<>ms.m group by all)""",
    """nall as (select m, sum(n_c) n_m from ncls group by m)""",
    """nkeys as (select r.device_id, ms.m from nbrows r join ms on r.fold is null or r.fold=ms.m)""",
]


NB_SOFTMAX = [
    """jmx as (select device_id, m, c, jll - max(jll) over (partition by device_id, m) z from jll)""",
    """pr as (select device_id, m, c, exp(z) / sum(exp(z)) over (partition by device_id, m) p from jmx)""",
]


def _nb_select(prefix: str, key: str = "device_id") -> str:
    return f"""select device_id {key},
  round_even(avg(case when c=0 then p end), 6) {prefix}_clf_0,
  round_even(avg(case when c=1 then p end), 6) {prefix}_clf_1
from pr group by device_id"""


def nb_stack_sql(kind: str, prefix: str, active: bool = False) -> str:
    mats = ACTIVE_MATRIX if active else APP_TAG_MATRIX
    return nb_sql(kind, prefix, [APP_EVENTS, DEVICES, FOLDS, TRIPLES, *mats, GENDER_NB_ROWS])


def nb_sql(kind: str, prefix: str, inputs: list[str], key: str = "device_id") -> str:
    """Out-of-fold naive Bayes over CTEs that define ``mat(device_id, col,
    value)`` and ``nbrows(device_id, label, fold)``, fold by fold."""
    head = [*inputs, *NB_ROWS]
    if kind == "multinomial":
        body = [
            """ncj as (select ms.m, r.label c, x.col, sum(x."value") n_cj from ms
  join nbrows r on r.fold is not null and r.fold<>ms.m join mat x on x.device_id=r.device_id group by all)""",
            """ncall as (select m, c, sum(n_cj) s from ncj group by all)""",
            """jll as (select k.device_id, k.m, n.c,
  ln(n.n_c/na.n_m) + coalesce(sum(x."value" * (ln(coalesce(j.n_cj,0)+1) - ln(coalesce(s.s,0)+vw.V))),0) jll
  from nkeys k join ncls n on n.m=k.m join nall na on na.m=k.m cross join vw
  left join ncall s on s.m=k.m and s.c=n.c
  left join mat x on x.device_id=k.device_id and x."value"<>0
  left join ncj j on j.m=k.m and j.c=n.c and j.col=x.col
  group by k.device_id, k.m, n.c, n.n_c, na.n_m)""",
        ]
    else:
        body = [
            """dcj as (select ms.m, r.label c, x.col, count(*) d_cj from ms
  join nbrows r on r.fold is not null and r.fold<>ms.m join mat x on x.device_id=r.device_id and x."value"<>0
  group by all)""",
            """bconst as (select n.m, n.c,
  coalesce((select sum(ln(1-(d.d_cj+1)/(n.n_c+2))) from dcj d where d.m=n.m and d.c=n.c),0)
  + ((select V from vw) - (select count(*) from dcj d where d.m=n.m and d.c=n.c)) * ln(1-1/(n.n_c+2)) k
  from ncls n)""",
            """jll as (select k.device_id, k.m, n.c,
  ln(n.n_c/na.n_m) + b.k + coalesce(sum(case when x.col is not null then
    ln((coalesce(j.d_cj,0)+1)/(n.n_c+2)) - ln(1-(coalesce(j.d_cj,0)+1)/(n.n_c+2)) end), 0) jll
  from nkeys k join ncls n on n.m=k.m join nall na on na.m=k.m join bconst b on b.m=n.m and b.c=n.c
  left join mat x on x.device_id=k.device_id and x."value"<>0
  left join dcj j on j.m=k.m and j.c=n.c and j.col=x.col
  group by k.device_id, k.m, n.c, n.n_c, na.n_m, b.k)""",
        ]
    return _with(*head, *body, *NB_SOFTMAX) + _nb_select(prefix, key)


def _enc_train(label: str, folds: str) -> str:
    return f"""t as (select d.device_id, d.{label} label, f.fold, e.phone_brand_{label}_kfold_mean p
  from devices d join {folds} f on d.device_id=f.device_id join enc_phone_brand e on d.device_id=e.device_id
  where d.is_train=1)"""


def encoding_binary_error_sql() -> str:
    return _with(DEVICES, FOLDS, _enc("phone_brand"), _enc_train("gender", "folds")) + """select fold,
  round(avg(case when cast(p>=0.5 as int)<>label then 1.0 else 0.0 end), 6) binary_error from t group by fold"""


def encoding_error_summary_sql() -> str:
    return _with(DEVICES, FOLDS, _enc("phone_brand"), _enc_train("gender", "folds"), """per as (
  select fold, avg(case when cast(p>=0.5 as int)<>label then 1.0 else 0.0 end) e from t group by fold)""") + \
        """select round(avg(e),6) binary_error_mean, round(stddev_pop(e),6) binary_error_std from per"""


def encoding_age_score_sql() -> str:
    return _with(DEVICES, AGE_FOLDS, _enc("phone_brand", "age", "age_folds"), _enc_train("age", "age_folds")) + \
        """select fold, round(avg(abs(label-p)),6) mae, round(1/(1+avg(abs(label-p))),7) age_score
from t group by fold"""


# Unicode word runs of 2+ characters: the vectoriser's token rule in RE2 terms.
DOC_TOKENS = """dtok as (select doc_id device_id,
  unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{M}\\p{Nd}\\p{Pc}]{2,}')) term from documents)"""
DOC_TF = """tf_txt as (select device_id, term, count(*) tf from dtok group by device_id, term)"""
DOC_N = """dn as (select count(*) n from documents)"""


def document_tfidf_sql() -> str:
    return _with(DOC_TOKENS, DOC_TF, DOC_N, """dfs as (select term, count(*) df from tf_txt group by term)""",
                 """w as (select t.device_id, t.term, t.tf, t.tf*(ln((1+dn.n)/(1+dfs.df))+1) w
  from tf_txt t join dfs on t.term=dfs.term cross join dn)""") + """select device_id doc_id, term,
  cast(tf as bigint) tf, round(w / sqrt(sum(w*w) over (partition by device_id)), 6) tfidf from w"""


def document_nb_sql() -> str:
    idf = """idf_txt as (select term, ln((1+(select n from dn))/(1+count(*)))+1 idf from tf_txt group by term)"""
    w = """w_txt as (select t.device_id, t.term, t.tf*i.idf w from tf_txt t join idf_txt i on t.term=i.term)"""
    mat = """mat as (
  select device_id, '00ctxt|'||term col, cast(tf as double) "value" from tf_txt
  union all select device_id, '01ttxt|'||term, w / sqrt(sum(w*w) over (partition by device_id)) from w_txt)"""
    dfolds = """dfolds as (
  select d.doc_id device_id, cast((row_number() over (order by l.quality,
    md5(concat(cast(d.doc_id as varchar), ':2021')))-1)%5 as int) fold
  from documents d join labels l on d.doc_id=l.doc_id where l.quality is not null)"""
    rows = """nbrows as (select d.doc_id device_id, l.quality label, f.fold
  from documents d left join labels l on d.doc_id=l.doc_id left join dfolds f on d.doc_id=f.device_id)"""
    return nb_sql("multinomial", "doc_mnb", [DOC_TOKENS, DOC_TF, DOC_N, idf, w, mat, dfolds, rows], key="doc_id")


# ---------------------------------------------------------------- the end-to-end path with closed-form models
def model_matrix_gender_sql() -> str:
    return f"""select f.* exclude (gender, age, is_train), m.* exclude (device_id), b.* exclude (device_id)
from ({device_features_sql()}) f
left join ({nb_stack_sql("multinomial", "tfidf_mnb")}) m on m.device_id=f.device_id
left join ({nb_stack_sql("bernoulli", "tfidf_bnb")}) b on b.device_id=f.device_id"""


def _gender_pred() -> str:
    return f"""(select device_id, cast(tfidf_mnb_clf_1>=0.5 as int) gender_pred from ({nb_stack_sql("multinomial", "tfidf_mnb")}))"""


def chained_gender_sql() -> str:
    return _with(DEVICES) + f"""select d.device_id, d.phone_brand, d.device_model, d.is_train,
  case when d.is_train=1 then d.gender else p.gender_pred end gender
from devices d left join {_gender_pred()} p on p.device_id=d.device_id"""


def result_join_sql() -> str:
    return _with(DEVICES, AGE_FOLDS, _enc("phone_brand", "age", "age_folds"), """raw as (
  select device_id from devices where is_train=0 union all
  select device_id from devices where is_train=0 and device_id%2=0)""") + f"""select r.device_id, p.gender_pred gender,
  round(e.phone_brand_age_kfold_mean, 6) age
from raw r left join {_gender_pred()} p on p.device_id=r.device_id
left join enc_phone_brand e on e.device_id=r.device_id"""


def best_log_loss_sql() -> str:
    return _with(DEVICES, FOLDS, _enc("phone_brand"), _enc_train("gender", "folds"), """per as (
  select fold, r, avg(-(label*ln(1/(1+exp(-(p-0.5)*r))) + (1-label)*ln(1-1/(1+exp(-(p-0.5)*r))))) loss
  from t, range(1, 9) rounds(r) group by fold, r)""") + """select fold,
  round(min(loss),6) best_log_loss, round(min(loss),6) best_log_loss_0 from per group by fold"""


def ridge_stack_sql(prefix: str, label: str, folds: str, alpha: float) -> str:
    """M6, M11 with M2: the normal equations of every fold model (all folds less
    its own, the bias as a last column without a penalty), solved by Gauss-Jordan
    steps over the augmented rows."""
    binary = label == "gender"
    target = "2.0*d.gender-1" if binary else "cast(d.age as double)"
    out = (f"round_even(1-avg(1/(1+exp(-u))), 6) {prefix}_clf_0, round_even(avg(1/(1+exp(-u))), 6) {prefix}_clf_1"
           if binary else f"round(avg(u), 6) {prefix}")
    steps = [
        f"""rr as (select d.device_id, {target} y, case when d.is_train=1 then f.fold end fold
  from devices d left join {folds} f using (device_id))""",
        """cols as (select col, cast(row_number() over (order by col) as int) j from (select distinct col from mat))""",
        """size as (select cast(count(*)+1 as int) d from cols)""",
        """x as (select device_id, j, "value" v from mat join cols using (col)
  union all select device_id, (select d from size), 1.0 from devices)""",
        """own as (select r.fold, a.j i, b.j, sum(a.v*b.v) s from x a join x b using (device_id) join rr r using (device_id)
  where r.fold is not null group by all
  union all select r.fold, a.j, (select d from size)+1, sum(a.v*r.y) from x a join rr r using (device_id)
  where r.fold is not null group by all)""",
        """ms as (select cast(range as int) m from range(5))""",
        f"""eq as (select m, i, j, sum(case when fold<>m then s else 0 end)
    + case when i=j and i<(select d from size) then {alpha} else 0 end s from own, ms group by m, i, j)""",
        """grid as (select m, cast(a.range as int) i, cast(b.range as int) j from ms, range(1, (select d from size)+1) a,
  range(1, (select d from size)+2) b)""",
        """aug as (select m, list(r order by i) a from (
  select m, i, list(coalesce(s, case when i=j and i<(select d from size) then """ + str(alpha) + """ else 0 end) order by j) r
  from grid left join eq using (m, i, j) group by m, i) group by m)""",
        """gj(m, k, a) using key (m) as (select m, 1, a from aug
  union all select m, k+1, list_transform(a, lambda r, i: case when i=k then list_transform(r, lambda z: z/r[k])
    else list_transform(list_zip(r, a[k]), lambda z: z[1]-r[k]/a[k][k]*z[2]) end) from gj where k<=(select d from size))""",
        """w as (select m, cast(unnest(range(1, len(a)+1)) as int) j, unnest(list_transform(a, lambda r: r[len(r)])) b from gj)""",
        """sc as (select r.device_id, w.m, sum(x.v*w.b) u from rr r join x using (device_id) join w using (j)
  where r.fold is null or r.fold=w.m group by all)""",
    ]
    text = _with(APP_EVENTS, DEVICES, FOLDS if folds == "folds" else AGE_FOLDS, TRIPLES, *APP_TAG_MATRIX, *steps)
    return text.replace("with ", "with recursive ", 1) + f"select device_id, {out} from sc group by device_id"


def matrix_vectors_sql() -> str:
    """T5 in long form: columns numbered from 0 in the order of their keys."""
    return _with(APP_EVENTS, DEVICES, TRIPLES, *APP_TAG_MATRIX) + """select device_id,
  dense_rank() over (order by col) - 1 idx, round("value", 6) "value" from mat"""


def kmeans_fixed_point_sql() -> str:
    """What the checked k-means must give: all devices, none misplaced."""
    return _with(DEVICES) + """select cast(unnest([5, 19, 70]) as int) k, (select count(distinct device_id) from devices) points,
  cast(0 as bigint) misplaced"""


def svd_residual_sql() -> str:
    """What the checked score columns must give: X Xᵀ s = σ² s for each."""
    return """select m.matrix, cast(c.range as int) component, true holds
from (select unnest(['tfidf_app_id', 'countvec_app_id', 'tfidf_tag_list', 'countvec_tag_list']) matrix) m, range(10) c"""


def embedded_sequence_sql() -> str:
    """Padded places joined to the vectors, zeros where there is none."""
    return _with(APP_EVENTS, TRIPLES, SEQ, RANKS, """coded as (
  select s.device_id, s.pos, r."rank", count(*) over (partition by s.device_id) n
  from seq s join ranks r on s.token=r.token)""", """places as (
  select device_id, unnest(range(50)) pos, unnest(list_concat(list_transform(range(greatest(50-count(*),0)), lambda x: 0),
    list(cast("rank" as bigint) order by pos))) token from coded where pos > n - 50 group by device_id)""") + """
select p.device_id, cast(p.pos as int) pos, array_to_string(list_transform(coalesce(e.embedding, list_transform(range(64), lambda x: 0)),
  lambda x: cast(floor(cast(x as double)*1000) as bigint)), ',') vec_text
from places p left join embeddings e on p.token > 0 and e.vec_id = p.token * 7"""


def event_id_sketches_sql() -> str:
    """The exact counts; every estimate must lie within its error."""
    return _with(APP_EVENTS) + """select device_id, count(distinct event_id) "exact", true "within"
from app_events where device_id is not null group by device_id"""


def skipgram_pairs_sql() -> str:
    """Sub-sampled tokens, numbered anew, met within their windows."""
    def uniform(*parts):
        return f"(cast('0x' || substr(md5({" || ':' || ".join(parts)}), 1, 8) as bigint) / 4294967296.0)"
    u, v = (uniform("cast(device_id as varchar)", "cast(pos as varchar)", tag) for tag in ("'2021'", "'2021 window'"))
    return _with(APP_EVENTS, TRIPLES, SEQ, """tc as (select token, count(*) cnt from seq group by token having count(*) >= 3)""",
                 """tot as (select sum(cnt) n from tc)""",
                 f"""kept as (select device_id, pos, token, floor({v} * 4) + 1 b from seq join tc using (token), tot
  where {u} < (sqrt((cnt / n) / 0.002) + 1) * (0.002 / (cnt / n)))""",
                 """placed as (select *, row_number() over (partition by device_id order by pos) k from kept)""") + """
select a.token centre, c.token context, count(*) n from placed a join placed c
  on a.device_id = c.device_id and c.k <> a.k and c.k between a.k - a.b and a.k + a.b group by all"""
