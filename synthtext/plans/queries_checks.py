"""Rule checks over run records (V1-V9).

Records are derived from ``events``: one JSON run record per event, built by
the same string concatenation on both sides (so both engines parse identical
documents), with values that trip every rule for some events.
``k = props.k`` (0..99), ``e = event_type``, ``id = event_id``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from synthtext.operators import checks as V
from synthtext.plans.registry import register, table
from synthtext.session import scratch_path, spread


# --------------------------------------------------------------------------
# Record text, written once as a tiny expression language rendered to both
# Spark Columns and DuckDB SQL.
# --------------------------------------------------------------------------
class _Sp:
    """Spark rendering."""

    def __init__(self, ev):
        self.k = F.col("__k")
        self.e = F.col("event_type")
        self.id = F.col("event_id")

    @staticmethod
    def s(x):
        return F.lit(x)

    @staticmethod
    def cat(*xs):
        return F.concat(*xs)

    @staticmethod
    def num(x):
        return x.cast("string")

    @staticmethod
    def case(*pairs, default):
        c = None
        for cond, val in pairs:
            c = F.when(cond, val) if c is None else c.when(cond, val)
        return c.otherwise(default)

    @staticmethod
    def div(x, n):
        return (x / n).cast("long")

    @staticmethod
    def mod(x, n):
        return F.pmod(x, F.lit(n))

    @staticmethod
    def lpad2(x):
        return F.lpad(x.cast("string"), 2, "0")

    @staticmethod
    def eq(a, b):
        return a == b

    @staticmethod
    def ne(a, b):
        return a != b

    @staticmethod
    def opt(cond, val):
        """``val`` when cond holds, else NULL (skipped by concat_ws)."""
        return F.when(cond, val)

    @staticmethod
    def join(*xs):
        return F.concat_ws(", ", *xs)


class _Sql:
    """DuckDB rendering (expressions are SQL text)."""

    k = "json_extract(props, '$.k')::BIGINT"
    e = "event_type"
    id = "event_id"

    @staticmethod
    def s(x):
        return "'" + x.replace("'", "''") + "'"

    @staticmethod
    def cat(*xs):
        return "(" + " || ".join(xs) + ")"

    @staticmethod
    def num(x):
        return f"({x})::VARCHAR"

    @staticmethod
    def case(*pairs, default):
        return "(CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in pairs) + f" ELSE {default} END)"

    @staticmethod
    def div(x, n):
        return f"(({x}) // {n})"

    @staticmethod
    def mod(x, n):
        return f"(({x}) % {n})"

    @staticmethod
    def lpad2(x):
        return f"lpad(({x})::VARCHAR, 2, '0')"

    @staticmethod
    def eq(a, b):
        return f"({a} = {b})"

    @staticmethod
    def ne(a, b):
        return f"({a} <> {b})"

    @staticmethod
    def opt(cond, val):
        return f"(CASE WHEN {cond} THEN {val} END)"

    @staticmethod
    def join(*xs):
        return "concat_ws(', ', " + ", ".join(xs) + ")"


def _sections(x):
    """(model, generation, logging, post_processing) JSON texts."""
    s, k, e, i = x.s, x.k, x.e, x.id

    def lit_if(cond, a, b):
        return x.case((cond, s(a)), default=s(b))

    model = x.cat(
        s('{"name": "m'), x.num(x.mod(i, 3)), s('", '),
        x.case((x.eq(x.mod(k, 5), _z(x, 0)), s("")),
               default=s('"pretrained_model_name_or_path": "p", ')),
        s('"model_type": "causal_lm", "quantization": {"enabled": '),
        lit_if(x.eq(x.mod(k, 2), _z(x, 0)), "true", "false"),
        x.case(
            (x.eq(x.mod(k, 3), _z(x, 0)), s("")),
            default=x.cat(
                s(', "bits": '),
                x.case((x.eq(x.mod(k, 9), _z(x, 1)), s('"8"')), default=x.num(_mul(x, x.mod(k, 3), 4))),
            ),
        ),
        s('}, "model_loading": {"use_cache": '),
        lit_if(x.eq(e, s("error")), '"yes"', "true"),
        s(', "trust_remote_code": false}, "tokenizer": {"add_bos_token": '),
        lit_if(x.eq(x.mod(k, 11), _z(x, 0)), "1", "false"),
        s(', "use_fast": true}}'),
    )
    gen = x.cat(
        s("{"),
        x.case(
            (x.ne(e, s("purchase")),
             x.cat(s('"temperature": '), x.case((x.eq(e, s("view")), s('"hot"')),
                                                 default=x.cat(x.num(_add(x, k, -20)), s(".5"))), s(", "))),
            default=s(""),
        ),
        s('"top_p": '), x.num(x.div(k, 40)), s("."), x.lpad2(x.mod(k, 40)),
        s(', "top_k": '), x.case((x.eq(e, s("click")), s("1.5")), default=x.num(_add(x, k, -20))),
        s(', "repetition_penalty": '), lit_if(x.eq(x.mod(k, 7), _z(x, 0)), "0", "1.1"),
        s(', "max_length": '), x.num(_add(x, _mul(x, k, 10), -100)),
        s(', "min_length": 50, "batch_size": '), x.num(_add(x, x.mod(i, 5), -1)),
        x.case(
            (x.eq(e, s("purchase")), s("")),
            default=x.cat(
                s(', "vllm": {"enabled": '), lit_if(x.eq(e, s("signup")), '"yes"', "true"),
                s(', "tensor_parallel_size": '), x.num(x.mod(k, 3)),
                s(', "gpu_memory_utilization": '), lit_if(x.eq(x.mod(k, 4), _z(x, 0)), "1.5", "0.9"),
                s("}"),
            ),
        ),
        s("}"),
    )
    logging = x.cat(
        s('{"enabled": '), lit_if(x.eq(e, s("view")), '"no"', "false"),
        s(', "project": '), lit_if(x.eq(x.mod(k, 6), _z(x, 0)), "7", '"proj"'),
        s(', "tags": '),
        x.case((x.eq(x.mod(k, 4), _z(x, 0)), s('"t"')), (x.eq(x.mod(k, 4), _z(x, 1)), s('["a", 1, "b", true]')),
               default=s('["a"]')),
        s(', "log_interval": '), x.num(_add(x, x.mod(k, 5), -1)),
        s(', "metrics": {"throughput": '), lit_if(x.eq(x.mod(k, 8), _z(x, 0)), '"y"', "true"),
        s(', "latency": true, "token_diversity": '), lit_if(x.eq(e, s("click")), "null", "true"),
        s(', "memory_usage": true}}'),
    )
    pp = x.cat(
        s('{"enabled": true, "max_length": '),
        x.case((x.eq(x.mod(k, 10), _z(x, 3)), s('"long"')), default=x.num(_add(x, _mul(x, k, 20), -100))),
        s(', "min_length": '), x.num(_add(x, x.mod(k, 7), -2)),
        s(', "complete_sentences": '), lit_if(x.eq(e, s("signup")), '"x"', "true"),
        s(', "deduplicate": true}'),
    )
    return model, gen, logging, pp


def _z(x, n):
    return str(n) if x is _Sql else F.lit(n)


def _add(x, a, n):
    return f"(({a}) + ({n}))" if x is _Sql else a + F.lit(n)


def _mul(x, a, n):
    return f"(({a}) * {n})" if x is _Sql else a * F.lit(n)


def _record(x):
    model, gen, logging, pp = _sections(x)
    s, k, e = x.s, x.k, x.e
    return x.cat(
        s("{"),
        x.join(
            x.opt(x.ne(e, s("purchase")), x.cat(s('"model": '), model)),
            x.opt(x.ne(e, s("error")), x.cat(s('"generation": '), gen)),
            x.cat(s('"logging": '), logging),
            x.opt(x.ne(x.mod(k, 9), _z(x, 0)), x.cat(s('"post_processing": '), pp)),
        ),
        s("}"),
    )


def records(spark, d):
    # props is parsed once; the record expression reads the column many times. A few
    # bytes of an event become a whole record, so splits are small.
    ev = spread(table(spark, d, "events"), 1 << 18).select(
        "event_id", "event_type", F.get_json_object("props", "$.k").cast("long").alias("__k")
    )
    x = _Sp(ev)
    return ev.select("event_id", _record(x).alias("record_json"))


RECORDS_SQL = f"SELECT event_id, {_record(_Sql)} AS record_json FROM events"


# --------------------------------------------------------------------------
# DuckDB statement of the rules (json_type: UBIGINT/BIGINT integers, DOUBLE
# decimals, VARCHAR, BOOLEAN, OBJECT, ARRAY, NULL; SQL NULL when absent).
# --------------------------------------------------------------------------
def _t(p):
    return f"json_type(j, '{p}')"


def _has(p):
    return f"{_t(p)} IS NOT NULL"


def _isint(p):
    return f"coalesce({_t(p)} IN ('BIGINT', 'UBIGINT'), false)"


def _isnum(p):
    return f"coalesce({_t(p)} IN ('BIGINT', 'UBIGINT', 'DOUBLE'), false)"


def _isbool(p):
    return f"coalesce({_t(p)} = 'BOOLEAN', false)"


def _isobj(p):
    return f"coalesce({_t(p)} = 'OBJECT', false)"


def _v(p):
    return f"TRY_CAST(json_extract(j, '{p}') AS DOUBLE)"


def _typed(p, name, kind, bad, msg):
    ok = _isint(p) if kind == "integer" else _isnum(p)
    art = "an integer" if kind == "integer" else "a number"
    return (f"CASE WHEN {_has(p)} AND NOT {ok} THEN '{name} must be {art}' "
            f"WHEN {_has(p)} AND {bad} THEN '{name} {msg}' END")


def _boolr(p, name):
    return f"CASE WHEN {_has(p)} AND NOT {_isbool(p)} THEN '{name} must be a boolean' END"


def _list(*cases):
    return "list_filter([" + ", ".join(cases) + "], lambda x: x IS NOT NULL)"


def sql_model(r):
    q = f"{r}.quantization"
    on = f"({_isobj(q)} AND {_has(q + '.enabled')} AND coalesce(TRY_CAST(json_extract(j, '{q}.enabled') AS BOOLEAN), false))"
    cases = [f"CASE WHEN NOT {_has(r + '.' + f)} THEN 'Missing required field: {f}' END"
             for f in ("name", "pretrained_model_name_or_path", "model_type")]
    cases.append(
        f"CASE WHEN {on} AND NOT {_has(q + '.bits')} THEN 'Missing required field: quantization.bits' "
        f"WHEN {on} AND NOT {_isnum(q + '.bits')} THEN 'quantization.bits must be a number' "
        f"WHEN {on} AND {_v(q + '.bits')} NOT IN (4, 8) THEN 'quantization.bits must be 4 or 8' END"
    )
    for sec, keys in (("model_loading", ("use_cache", "trust_remote_code")), ("tokenizer", ("add_bos_token", "use_fast"))):
        for key in keys:
            p = f"{r}.{sec}.{key}"
            cases.append(f"CASE WHEN {_isobj(r + '.' + sec)} AND {_has(p)} AND NOT {_isbool(p)} "
                         f"THEN '{sec}.{key} must be a boolean' END")
    return _list(*cases)


def sql_generation(r):
    def p(key):
        return f"{r}.{key}"

    cases = [
        _typed(p("temperature"), "temperature", "number", f"{_v(p('temperature'))} <= 0", "must be positive"),
        _typed(p("top_p"), "top_p", "number", f"NOT ({_v(p('top_p'))} BETWEEN 0 AND 1)", "must be between 0 and 1"),
        _typed(p("top_k"), "top_k", "integer", f"{_v(p('top_k'))} < 0", "must be non-negative"),
        _typed(p("repetition_penalty"), "repetition_penalty", "number", f"{_v(p('repetition_penalty'))} <= 0",
               "must be positive"),
        _typed(p("max_length"), "max_length", "integer", f"{_v(p('max_length'))} <= 0", "must be positive"),
        _typed(p("min_length"), "min_length", "integer", f"{_v(p('min_length'))} < 0", "must be non-negative"),
        f"CASE WHEN {_isint(p('max_length'))} AND {_isint(p('min_length'))} AND "
        f"{_v(p('min_length'))} > {_v(p('max_length'))} THEN 'min_length must be less than or equal to max_length' END",
        _typed(p("batch_size"), "batch_size", "integer", f"{_v(p('batch_size'))} <= 0", "must be positive"),
    ]
    vo = _isobj(p("vllm"))
    vp = p("vllm")
    cases.append(f"CASE WHEN {vo} THEN {_boolr(vp + '.enabled', 'vllm.enabled')} END")
    cases.append(f"CASE WHEN {vo} THEN {_typed(vp + '.tensor_parallel_size', 'vllm.tensor_parallel_size', 'integer', _v(vp + '.tensor_parallel_size') + ' <= 0', 'must be positive')} END")
    g = _v(vp + ".gpu_memory_utilization")
    cases.append(f"CASE WHEN {vo} THEN {_typed(vp + '.gpu_memory_utilization', 'vllm.gpu_memory_utilization', 'number', f'NOT ({g} > 0 AND {g} <= 1)', 'must be between 0 and 1')} END")
    return _list(*cases)


def sql_logging(r):
    tags = f"{r}.tags"
    head = _list(
        _boolr(r + ".enabled", "enabled"),
        f"CASE WHEN {_has(r + '.project')} AND coalesce({_t(r + '.project')} <> 'VARCHAR', true) THEN 'project must be a string' END",
        f"CASE WHEN {_has(tags)} AND coalesce({_t(tags)} <> 'ARRAY', true) THEN 'tags must be a list' END",
    )
    items = (
        f"list_filter(list_transform(CASE WHEN {_t(tags)} = 'ARRAY' THEN json_extract(j, '{tags}')::JSON[] "
        f"ELSE []::JSON[] END, lambda x, i: CASE WHEN json_type(x) <> 'VARCHAR' THEN 'tags[' || (i - 1)::VARCHAR "
        f"|| '] must be a string' END), lambda y: y IS NOT NULL)"
    )
    tail = _list(
        _typed(r + ".log_interval", "log_interval", "integer", f"{_v(r + '.log_interval')} <= 0", "must be positive"),
        *[f"CASE WHEN {_isobj(r + '.metrics')} THEN {_boolr(f'{r}.metrics.{m}', f'metrics.{m}')} END"
          for m in ("throughput", "latency", "token_diversity", "memory_usage")],
    )
    return f"list_concat({head}, {items}, {tail})"


def sql_post_processing(r):
    return _list(
        _boolr(r + ".enabled", "enabled"),
        _typed(r + ".max_length", "max_length", "integer", f"{_v(r + '.max_length')} <= 0", "must be positive"),
        _typed(r + ".min_length", "min_length", "integer", f"{_v(r + '.min_length')} < 0", "must be non-negative"),
        _boolr(r + ".complete_sentences", "complete_sentences"),
        _boolr(r + ".deduplicate", "deduplicate"),
    )


SQL_SECTIONS = {
    "model": sql_model,
    "generation": sql_generation,
    "logging": sql_logging,
    "post_processing": sql_post_processing,
}


def _section_sql(sec):
    return (f"CASE WHEN {_has('$.' + sec)} THEN {SQL_SECTIONS[sec]('$.' + sec)} "
            f"ELSE ['{V.MISSING_SECTION[sec]}'] END")


# --------------------------------------------------------------------------
# Queries
# --------------------------------------------------------------------------
@register(
    "q_rule_generation",
    f"WITH r AS ({RECORDS_SQL}), g AS (SELECT event_id, json_extract(record_json, '$.generation') AS j "
    f"FROM r WHERE json_type(record_json, '$.generation') IS NOT NULL) "
    f"SELECT event_id, len(e)::BIGINT AS n_errors, array_to_string(e, '; ') AS errors "
    f"FROM (SELECT event_id, {sql_generation('$')} AS e FROM g)",
)
def q_rule_generation(spark, d):
    """V3 on the generation section of every record that has one."""
    recs = records(spark, d).withColumn("v", F.try_parse_json("record_json"))
    recs = recs.where(F.try_variant_get("v", "$.generation", "variant").isNotNull())
    checked = V.with_section_errors(recs, "v", "generation", "errs")
    return checked.select(
        "event_id", F.size("errs").cast("long").alias("n_errors"), F.array_join("errs", "; ").alias("errors")
    )


_REPORT_SQL = (
    f"WITH r AS ({RECORDS_SQL}), j AS (SELECT event_id, record_json::JSON AS j FROM r), "
    "s AS (" + " UNION ALL ".join(
        f"SELECT event_id, '{sec}' AS section, {_section_sql(sec)} AS msgs FROM j" for sec in SQL_SECTIONS
    ) + ") SELECT event_id, section, unnest(msgs) AS message FROM s"
)


@register("q_rule_report", _REPORT_SQL)
def q_rule_report(spark, d):
    """V6 + V9: one line per (record, section, message)."""
    checked = V.check_records(records(spark, d), "record_json")
    rep = V.error_report(checked, ("event_id",))
    return rep.withColumnRenamed("kind", "section")


@register(
    "q_rule_summary",
    f"WITH x AS ({_REPORT_SQL}) SELECT section, count(*)::BIGINT AS n_messages, "
    "count(DISTINCT event_id)::BIGINT AS n_records FROM x GROUP BY section",
)
def q_rule_summary(spark, d):
    """V9: messages and failing records per section."""
    rep = q_rule_report(spark, d)
    return rep.groupBy("section").agg(
        F.count(F.lit(1)).cast("long").alias("n_messages"),
        F.countDistinct("event_id").cast("long").alias("n_records"),
    )


@register(
    "q_rule_valid_split",
    f"WITH x AS ({_REPORT_SQL}) SELECT ((SELECT count(*) FROM events) - count(DISTINCT event_id))::BIGINT "
    "AS n_valid, count(DISTINCT event_id)::BIGINT AS n_quarantined FROM x",
)
def q_rule_valid_split(spark, d):
    """V9: rows passing vs quarantined, one aggregate over the checked rows."""
    checked = V.check_records(records(spark, d), "record_json")
    return checked.select(
        F.count_if(V.n_errors(checked) == 0).cast("long").alias("n_valid"),
        F.count_if(V.n_errors(checked) > 0).cast("long").alias("n_quarantined"),
    )


_SEC_FILES = ("model", "generation", "logging", "post_processing")


@register(
    "q_config_files",
    f"WITH r AS ({RECORDS_SQL}), j AS (SELECT event_id, record_json::JSON AS rec FROM r), "
    "s AS (" + " UNION ALL ".join(
        f"SELECT '{sec}' AS section, event_id, {SQL_SECTIONS[sec]('$')} AS msgs "
        f"FROM (SELECT event_id, json_extract(rec, '$.{sec}') AS j FROM j WHERE json_type(rec, '$.{sec}') IS NOT NULL)"
        for sec in _SEC_FILES
    ) + ") SELECT section, event_id, unnest(msgs) AS message FROM s",
)
def q_config_files(spark, d):
    """V7 + V8: section documents written as files under <root>/<section>/,
    one JSON document per line, checked by folder; root-level and unknown
    folders are parsed only."""
    recs = records(spark, d).withColumn("v", F.try_parse_json("record_json"))
    root = scratch_path(spark, "configs")
    # One job writes every section's documents (and whole records into a
    # folder no rule knows) into section=<name>/ folders.
    docs = F.array(
        *[F.struct(F.lit(sec).alias("section"), F.to_json(F.struct(
            F.col("event_id").alias("id"), F.try_variant_get("v", f"$.{sec}", "variant").alias("doc")
        )).alias("value"), F.try_variant_get("v", f"$.{sec}", "variant").isNotNull().alias("keep"))
          for sec in _SEC_FILES],
        F.struct(F.lit("unknown_kind").alias("section"), F.col("record_json").alias("value"), F.lit(True).alias("keep")),
    )
    out = recs.select(F.inline(docs)).where("keep").select("section", "value")
    out.write.mode("overwrite").partitionBy("section").text(root)
    checked = V.check_files(spark, root, suffix=".txt", lines=True, doc_path="$.doc")
    rep = checked.where(F.col("section").isin(*_SEC_FILES)).select(
        "section", F.get_json_object("value", "$.id").cast("long").alias("event_id"),
        V.messages(F.col("errors")),
    )
    return rep


@register(
    "q_rule_checks",
    f"WITH r AS ({RECORDS_SQL}), j AS (SELECT event_id, record_json::JSON AS j FROM r) SELECT event_id, "
    + ", ".join(f"array_to_string({_section_sql(sec)}, '; ') AS {sec}_errors" for sec in SQL_SECTIONS)
    + " FROM j",
)
def q_rule_checks(spark, d):
    """V2-V6: per record, each section's messages (or its 'Missing' message)."""
    recs = records(spark, d).withColumn("v", F.try_parse_json("record_json"))
    for sec in V.SECTION_CHECKS:
        recs = V.with_section_errors(recs, "v", sec, f"{sec}_e")
    return recs.select(
        "event_id", *[F.array_join(f"{sec}_e", "; ").alias(f"{sec}_errors") for sec in V.SECTION_CHECKS]
    )


_REQUIRED = {"model": {"name": "", "model_type": ""}, "generation": {"temperature": 0, "vllm": {"swap_space": 0}}, "logging": ""}


def _required_sql():
    """V1 over the schema above, stated path by path."""
    cases = []
    for path in ("model", "model.name", "model.model_type", "generation", "generation.temperature", "generation.vllm",
                 "generation.vllm.swap_space", "logging"):
        head, _, key = path.rpartition(".")
        parents = [".".join(head.split(".")[:i + 1]) for i in range(len(head.split(".")))] if head else []
        below = " AND ".join([_isobj("$." + x) for x in parents] + [f"NOT {_has('$.' + path)}"])
        cases.append(f"CASE WHEN {below} THEN '{head + '.' if head else ''}Missing required field: {key}' END")
    return _list(*cases)


@register(
    "q_rule_required",
    f"WITH r AS ({RECORDS_SQL}), j AS (SELECT event_id, record_json::JSON AS j FROM r) "
    f"SELECT event_id, array_to_string({_required_sql()}, '; ') AS missing FROM j",
)
def q_rule_required(spark, d):
    """V1: required fields, also below present objects."""
    recs = records(spark, d).withColumn("v", F.try_parse_json("record_json"))
    return recs.select("event_id", F.array_join(V.required_errors(F.col("v"), _REQUIRED), "; ").alias("missing"))


@register(
    "q_rule_malformed",
    "SELECT CASE event_id % 3 WHEN 0 THEN 'syntax' ELSE 'loading' END AS section, "
    "CASE event_id % 3 WHEN 0 THEN 'invalid JSON' ELSE 'not a record' END AS message, count(*)::BIGINT AS n "
    "FROM events GROUP BY ALL",
)
def q_rule_malformed(spark, d):
    """V8: records cut off, arrays and bare texts in place of records."""
    r = F.col("record_json")
    bad = (F.when(F.col("event_id") % 3 == 0, F.substring(r, 1, 5)).when(F.col("event_id") % 3 == 1, F.concat(
        F.lit("["), r, F.lit("]"))).otherwise(F.lit('"text"')))
    checked = V.check_records(records(spark, d).withColumn("record_json", bad), "record_json")
    rep = V.error_report(checked, ("event_id",))
    return rep.groupBy(F.col("kind").alias("section"), "message").agg(F.count(F.lit(1)).alias("n"))
