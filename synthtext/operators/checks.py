"""Rule checks over run records (V1-V9).

A Spark user has a *table* of run records (one JSON document per run or per
configuration file), not one tree. Records are parsed to VARIANT; every rule
is a ``CASE WHEN <violation> THEN <message> END`` and a record's errors are
the non-null messages, so checking is one projection per record: no shuffle,
no Python. The message texts are the contract.

Typing rules: a key that is absent does not trigger a rule (unless it is
required); a key holding JSON null is present and of no type. Integers are
numbers, decimals are numbers but not integers, and JSON ``true``/``false``
are booleans only (never numbers).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from synthtext.session import small_methods

_INT_TYPES = ("TINYINT", "SMALLINT", "INT", "BIGINT")

# ---------------------------------------------------------------------------
# The rule message texts (the contract), the required model
# fields and the logged metric names.
# ---------------------------------------------------------------------------
MSG_MISSING = "Missing required field: {}"
MSG_BOOLEAN = "{} must be a boolean"
MSG_NUMBER = "{} must be a number"
MSG_INTEGER = "{} must be an integer"
MSG_STRING = "{} must be a string"
MSG_LIST = "{} must be a list"
MSG_TAG = "tags[{}] must be a string"
MSG_POSITIVE = "must be positive"
MSG_NON_NEGATIVE = "must be non-negative"
MSG_UNIT = "must be between 0 and 1"
MSG_BITS = "quantization.bits must be 4 or 8"
MSG_MIN_MAX = "min_length must be less than or equal to max_length"
MODEL_REQUIRED = ("name", "pretrained_model_name_or_path", "model_type")
LOGGED_METRICS = ("throughput", "latency", "token_diversity", "memory_usage")
MISSING_SECTION = {
    "model": "Missing model configuration",
    "generation": "Missing generation configuration",
    "logging": "Missing logging configuration",
    "post_processing": "Missing post-processing configuration",
}


class Rec:
    """Typed view of one JSON object of a record: per key its type name and
    numeric value, materialised once per row (see ``with_views``) so every
    rule is a field access instead of a fresh walk of the variant."""

    def __init__(self, types: Column, nums: Column, v: Column | None = None, prefix: str = "$",
                 subs: dict[str, "Rec"] | None = None, item_types: Column | None = None):
        self.types = types
        self.nums = nums
        self.v = v
        self.prefix = prefix
        self.subs = subs or {}
        self.item_types = item_types

    def sub(self, key: str) -> "Rec":
        return self.subs[key]

    def has(self, key: str) -> Column:
        return self.types.getItem(key).isNotNull()

    def typ(self, key: str) -> Column:
        return self.types.getItem(key)

    def is_object(self, key: str) -> Column:
        return F.coalesce(self.typ(key).startswith("OBJECT"), F.lit(False))

    def is_bool(self, key: str) -> Column:
        return F.coalesce(self.typ(key) == "BOOLEAN", F.lit(False))

    def is_int(self, key: str) -> Column:
        return F.coalesce(self.typ(key).isin(*_INT_TYPES), F.lit(False))

    def is_num(self, key: str) -> Column:
        t = self.typ(key)
        return F.coalesce(t.isin(*_INT_TYPES, "FLOAT", "DOUBLE") | t.startswith("DECIMAL"), F.lit(False))

    def is_str(self, key: str) -> Column:
        return F.coalesce(self.typ(key) == "STRING", F.lit(False))

    def num(self, key: str) -> Column:
        return self.nums.getItem(key)

    def truthy(self, key: str) -> Column:
        """Python truthiness of a value (booleans and numbers by value,
        strings/arrays by length, objects when non-empty)."""
        t = self.typ(key)
        out = F.when(t == "BOOLEAN", self.num(key) != 0).when(self.is_num(key), self.num(key) != 0)
        if self.v is not None:
            path = f"{self.prefix}.{key}"
            out = out.when(t == "STRING", F.length(F.try_variant_get(self.v, path, "string")) > 0).when(
                t.startswith("ARRAY"), F.size(F.try_variant_get(self.v, path, "array<variant>")) > 0
            )
        return out.when(t.startswith("OBJECT"), t != "OBJECT<>").otherwise(F.lit(False))


# The keys each section's rules read, per (sub-)object ("" = the section).
SECTION_KEYS = {
    "model": {
        "": MODEL_REQUIRED + ("quantization", "model_loading", "tokenizer"),
        "quantization": ("enabled", "bits"),
        "model_loading": ("use_cache", "trust_remote_code"),
        "tokenizer": ("add_bos_token", "use_fast"),
    },
    "generation": {
        "": ("temperature", "top_p", "top_k", "repetition_penalty", "max_length", "min_length",
             "batch_size", "vllm"),
        "vllm": ("enabled", "tensor_parallel_size", "gpu_memory_utilization"),
    },
    "logging": {"": ("enabled", "project", "tags", "log_interval", "metrics"), "metrics": LOGGED_METRICS},
    "post_processing": {"": ("enabled", "max_length", "min_length", "complete_sentences", "deduplicate")},
}
# Of those, the keys whose values the rules read as numbers (a truth value is 0 or 1).
NUMBER_KEYS = {
    "model": {"quantization": ("enabled", "bits")},
    "generation": {
        "": ("temperature", "top_p", "top_k", "repetition_penalty", "max_length", "min_length", "batch_size"),
        "vllm": ("tensor_parallel_size", "gpu_memory_utilization"),
    },
    "logging": {"": ("log_interval",)},
    "post_processing": {"": ("max_length", "min_length")},
}


def with_views(df: DataFrame, sections: Mapping[str, tuple[str, str]]) -> tuple[DataFrame, dict[str, Rec]]:
    """Materialise the typed views of sections and their sub-objects: ``sections`` names the
    VARIANT column and the tag of each.

    Each object is extracted once as ``STRUCT<key VARIANT, ...>`` over the keys
    the rules read (a missing key is NULL, a JSON null stays present), sub-objects out of
    their parent's; then one projection holds every key's type name and one the values of
    the keys that rules read as numbers, where they are some: a text is never cast.
    All sections are done in the same few projections, as each one copies the row.
    Plain field expressions only; Catalyst keeps the projections apart because the rules
    read each field many times.
    """
    def name(section: str, sub: str) -> str:
        return f"__{sections[section][1]}_{sub or 'root'}"

    def obj(whole: Column, section: str, sub: str) -> Column:
        return F.try_variant_get(whole, "$", "struct<" + ",".join(f"`{k}`:variant" for k in SECTION_KEYS[section][sub]) + ">")

    def rec(section: str, sub: str) -> Rec:
        n = name(section, sub)
        return Rec(F.col(n + "_t"), F.col(n + "_n"), F.col(sections[section][0]), f"$.{sub}" if sub else "$")

    d = df.withColumns({name(s, "") + "_o": obj(F.col(c), s, "") for s, (c, _) in sections.items()})
    views = {name(s, sub) + "_o": obj(F.col(name(s, "") + "_o")[sub], s, sub)
             for s in sections for sub in SECTION_KEYS[s] if sub}
    if "logging" in sections:
        tags = F.try_variant_get(F.col(name("logging", "") + "_o")["tags"], "$", "array<variant>")
        views[name("logging", "tags")] = F.transform(tags, lambda x: F.schema_of_variant(x))
    d = d.withColumns(views)
    d = d.withColumns({name(s, sub) + "_t": F.struct(*[
        F.schema_of_variant(F.col(name(s, sub) + "_o")[k]).alias(k) for k in keys])
        for s in sections for sub, keys in SECTION_KEYS[s].items()})

    def number(s: str, sub: str, key: str) -> Column:
        r = rec(s, sub)
        return F.when(r.is_num(key) | r.is_bool(key), F.try_variant_get(F.col(name(s, sub) + "_o")[key], "$", "double")).alias(key)

    d = d.withColumns({name(s, sub) + "_n": F.struct(*[number(s, sub, k) for k in keys])
                       for s in sections for sub, keys in NUMBER_KEYS[s].items()})
    recs = {}
    for s in sections:
        recs[s] = rec(s, "")
        recs[s].subs = {sub: rec(s, sub) for sub in SECTION_KEYS[s] if sub}
        recs[s].item_types = F.col(name(s, "tags")) if s == "logging" else None
    return d, recs


def _drop_views(df: DataFrame, tag: str) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(f"__{tag}_")])


#: between messages of one record; no message holds it
_BREAK = "\x01"


def _errors(*cases: Column) -> Column:
    """The cases that are not null. Joined and cut again as a text: that stays in generated
    code, where a filter over an array of cases would interpret every rule."""
    joined = F.concat_ws(_BREAK, *cases)
    return F.when(joined == "", F.array().cast("array<string>")).otherwise(F.split(joined, _BREAK))


def _msg(cond: Column, text: str | Column) -> Column:
    return F.when(cond, text if isinstance(text, Column) else F.lit(text))


def _bool_rule(r: Rec, key: str, label: str | None = None) -> Column:
    return _msg(r.has(key) & ~r.is_bool(key), MSG_BOOLEAN.format(label or key))


def _typed_range(r: Rec, key: str, kind: str, bad: Column, range_msg: str, label: str | None = None) -> Column:
    """Type first; the range rule only applies when the type is right."""
    name = label or key
    ok_type = r.is_int(key) if kind == "integer" else r.is_num(key)
    type_msg = (MSG_INTEGER if kind == "integer" else MSG_NUMBER).format(name)
    return F.when(r.has(key) & ~ok_type, F.lit(type_msg)).when(
        r.has(key) & bad, F.lit(f"{name} {range_msg}")
    )


# --------------------------------------------------------------------------
# V1: required structure
# --------------------------------------------------------------------------
def _required_paths(schema: Mapping, prefix: tuple = ()) -> list[tuple[tuple, bool]]:
    out = []
    for key, value in schema.items():
        out.append((prefix + (key,), isinstance(value, Mapping)))
        if isinstance(value, Mapping):
            out += _required_paths(value, prefix + (key,))
    return out


def required_errors(v: Column, schema: Mapping) -> Column:
    """V1: every schema key present; nested keys are checked only below a
    present object and reported as ``parent.Missing required field: key``."""

    def at(path: tuple) -> Column:
        return F.try_variant_get(v, "$." + ".".join(path), "variant")

    cases = []
    for path, _ in _required_paths(schema):
        parents_ok = F.lit(True)
        for i in range(1, len(path)):
            parents_ok = parents_ok & F.coalesce(F.schema_of_variant(at(path[:i])).startswith("OBJECT"), F.lit(False))
        msg = ".".join(path[:-1] + (MSG_MISSING.format(path[-1]),))
        cases.append(_msg(parents_ok & at(path).isNull(), msg))
    return _errors(*cases) if cases else F.array().cast("array<string>")


# --------------------------------------------------------------------------
# V2-V5: section rules
# --------------------------------------------------------------------------
def model_errors(r: Rec) -> Column:
    """V2: model section."""
    cases = [_msg(~r.has(f), MSG_MISSING.format(f)) for f in MODEL_REQUIRED]
    q = r.sub("quantization")
    on = r.is_object("quantization") & q.has("enabled") & q.truthy("enabled")
    bits = q.num("bits")
    cases.append(
        F.when(on & ~q.has("bits"), F.lit(MSG_MISSING.format("quantization.bits")))
        .when(on & ~q.is_num("bits"), F.lit(MSG_NUMBER.format("quantization.bits")))
        .when(on & ~bits.isin(4.0, 8.0), F.lit(MSG_BITS))
    )
    ml = r.sub("model_loading")
    for k in ("use_cache", "trust_remote_code"):
        cases.append(_msg(r.is_object("model_loading") & ml.has(k) & ~ml.is_bool(k), MSG_BOOLEAN.format(f"model_loading.{k}")))
    tk = r.sub("tokenizer")
    for k in ("add_bos_token", "use_fast"):
        cases.append(_msg(r.is_object("tokenizer") & tk.has(k) & ~tk.is_bool(k), MSG_BOOLEAN.format(f"tokenizer.{k}")))
    return _errors(*cases)


def generation_errors(r: Rec) -> Column:
    """V3: generation section."""
    cases = [
        _typed_range(r, "temperature", "number", r.num("temperature") <= 0, MSG_POSITIVE),
        _typed_range(r, "top_p", "number", ~r.num("top_p").between(0, 1), MSG_UNIT),
        _typed_range(r, "top_k", "integer", r.num("top_k") < 0, MSG_NON_NEGATIVE),
        _typed_range(r, "repetition_penalty", "number", r.num("repetition_penalty") <= 0, MSG_POSITIVE),
        _typed_range(r, "max_length", "integer", r.num("max_length") <= 0, MSG_POSITIVE),
        _typed_range(r, "min_length", "integer", r.num("min_length") < 0, MSG_NON_NEGATIVE),
        _msg(
            r.is_int("max_length") & r.is_int("min_length") & (r.num("min_length") > r.num("max_length")),
            MSG_MIN_MAX,
        ),
        _typed_range(r, "batch_size", "integer", r.num("batch_size") <= 0, MSG_POSITIVE),
    ]
    vl = r.sub("vllm")
    is_obj = r.is_object("vllm")
    cases.append(_msg(is_obj & vl.has("enabled") & ~vl.is_bool("enabled"), MSG_BOOLEAN.format("vllm.enabled")))
    tp = _typed_range(vl, "tensor_parallel_size", "integer", vl.num("tensor_parallel_size") <= 0,
                      MSG_POSITIVE, "vllm.tensor_parallel_size")
    gm = vl.num("gpu_memory_utilization")
    gu = _typed_range(vl, "gpu_memory_utilization", "number", ~((gm > 0) & (gm <= 1)),
                      MSG_UNIT, "vllm.gpu_memory_utilization")
    cases += [F.when(is_obj, tp), F.when(is_obj, gu)]
    return _errors(*cases)




def logging_errors(r: Rec) -> Column:
    """V4: logging section, in rule order: enabled, project, tags (the list
    rule or one message per non-string tag), log_interval, metrics.*."""
    head = _errors(
        _bool_rule(r, "enabled"),
        _msg(r.has("project") & ~r.is_str("project"), MSG_STRING.format("project")),
        _msg(r.has("tags") & ~F.coalesce(r.typ("tags").startswith("ARRAY"), F.lit(False)), MSG_LIST.format("tags")),
    )
    tag_errs = F.filter(
        F.transform(
            F.coalesce(r.item_types, F.array().cast("array<string>")),
            lambda x, i: F.when(
                x != "STRING",
                F.format_string(MSG_TAG.replace("{}", "%d"), i),
            ),
        ),
        lambda x: x.isNotNull(),
    )
    m = r.sub("metrics")
    tail = _errors(
        _typed_range(r, "log_interval", "integer", r.num("log_interval") <= 0, MSG_POSITIVE),
        *[_msg(r.is_object("metrics") & m.has(k) & ~m.is_bool(k), MSG_BOOLEAN.format(f"metrics.{k}"))
          for k in LOGGED_METRICS],
    )
    return F.concat(head, tag_errs, tail)


def post_processing_errors(r: Rec) -> Column:
    """V5: post-processing section."""
    return _errors(
        _bool_rule(r, "enabled"),
        _typed_range(r, "max_length", "integer", r.num("max_length") <= 0, MSG_POSITIVE),
        _typed_range(r, "min_length", "integer", r.num("min_length") < 0, MSG_NON_NEGATIVE),
        _bool_rule(r, "complete_sentences"),
        _bool_rule(r, "deduplicate"),
    )


SECTION_CHECKS = {
    "model": model_errors,
    "generation": generation_errors,
    "logging": logging_errors,
    "post_processing": post_processing_errors,
}


def with_section_errors(df: DataFrame, v_col: str, section: str, out: str, path: str | None = None,
                        missing_message: bool = True, only_when: Column | None = None) -> DataFrame:
    """Errors of one section as ``ARRAY<STRING>`` column ``out``.

    ``path`` locates the section (default ``$.<section>``, i.e. inside a full
    record); an absent section gives its 'Missing ... configuration' message
    (or no message with ``missing_message=False``). ``only_when`` limits the
    extraction to the rows that need this section's rules.
    """
    when = None if only_when is None else {section: only_when}
    return with_all_errors(df, v_col, {section: out}, path, missing_message, when)


def with_all_errors(df: DataFrame, v_col: str, outs: Mapping[str, str], path: str | None = None,
                    missing_message: bool = True, only_when: Mapping[str, Column] | None = None,
                    more: Mapping[str, Column] | None = None) -> DataFrame:
    """``with_section_errors`` of several sections (``outs`` names the column of each) in the
    same projections. ``more`` are further columns to be read off the VARIANT with them."""
    small_methods(df.sparkSession)

    def own(section: str) -> Column:
        part = F.try_variant_get(F.col(v_col), path or f"$.{section}", "variant")
        return F.when(only_when[section], part) if only_when else part

    d = df.withColumns({f"__{out}_section": own(s) for s, out in outs.items()} | dict(more or {}))
    d, recs = with_views(d, {s: (f"__{out}_section", out) for s, out in outs.items()})
    d = d.withColumns({out: F.when(F.col(f"__{out}_section").isNotNull(), SECTION_CHECKS[s](recs[s])).otherwise(
        F.array(F.lit(MISSING_SECTION[s])) if missing_message else F.array().cast("array<string>")) for s, out in outs.items()})
    for out in outs.values():
        d = _drop_views(d, out)
    return d


def with_record_errors(df: DataFrame, v_col: str, out: str = "errors", more: Mapping[str, Column] | None = None) -> DataFrame:
    """V6: ``MAP<section, ARRAY<message>>`` holding only sections with errors."""
    d = with_all_errors(df, v_col, {sec: f"__err_{sec}" for sec in SECTION_CHECKS}, more=more)
    m = F.map_from_arrays(
        F.array(*[F.lit(s) for s in SECTION_CHECKS]),
        F.array(*[F.col(f"__err_{s}") for s in SECTION_CHECKS]),
    )
    d = d.withColumn(out, F.map_filter(m, lambda k, e: F.size(e) > 0))
    return d.drop(*[f"__err_{s}" for s in SECTION_CHECKS])


INVALID_JSON, NOT_A_RECORD = "invalid JSON", "not a record"


def _parsed(col: str) -> Column:
    """The VARIANT of a JSON text, null where it is not JSON; a text above the
    size that a VARIANT holds raises, as it may well be valid. The size is looked at
    first, so every text is parsed once."""
    v = F.try_parse_json(F.col(col))
    return F.when(F.octet_length(col) > F.lit(128 << 20), F.coalesce(v, F.raise_error(
        F.lit("a JSON record of more than 128 MiB does not fit a VARIANT")))).otherwise(v)


def _is_object(v: Column) -> Column:
    """Whether a VARIANT is an object; none of its values is read."""
    return F.try_variant_get(v, "$", "struct<>").isNotNull()


def check_records(df: DataFrame, json_col: str = "config_json", out: str = "errors") -> DataFrame:
    """V6 + V8 over a table of JSON run records: unparsable text is reported
    under ``syntax``, a value that is no object under ``loading``; otherwise
    section -> messages."""
    v = F.col("__v")
    d = df.withColumn("__v", _parsed(json_col))
    # what is asked of the whole record is asked first, so that it goes no further
    d = with_record_errors(d, "__v", "__errs", {"__none": v.isNull(), "__flat": ~_is_object(v)})
    syntax = F.create_map(F.lit("syntax"), F.array(F.lit(INVALID_JSON)))
    loading = F.create_map(F.lit("loading"), F.array(F.lit(NOT_A_RECORD)))
    d = d.withColumn(out, F.when(F.col("__none"), syntax).when(F.col("__flat"), loading).otherwise(F.col("__errs")))
    return d.drop("__v", "__errs", "__none", "__flat")


# --------------------------------------------------------------------------
# V7-V9: configuration files and reports
# --------------------------------------------------------------------------
def check_files(spark: SparkSession, root: str, suffix: str = ".json", lines: bool = False,
                doc_path: str = "$") -> DataFrame:
    """V7 + V8: every ``*<suffix>`` file below ``root``; the first folder below
    the root names the section (unknown sections pass, root-level files are
    only parsed). One JSON document per file, or per line with ``lines=True``;
    ``doc_path`` locates the section document inside each JSON value.

    Returns ``(file_path, value, section, kind, errors)``.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}")
    files = (reader.text(root) if lines else reader.text(root, wholetext=True)).select(
        F.col("_metadata.file_path").alias("file_path"), "value"
    )
    if lines:
        files = files.where(F.length(F.trim("value")) > 0)
    # Path below the root, whatever URI scheme the file listing reports.
    rootp = root.rstrip("/").removeprefix("file:")
    rel = F.regexp_replace(F.col("file_path"), "^.*?\\Q" + rootp + "\\E/", "")
    parts = F.split(rel, "/")
    # The first folder names the section; a Hive-style "name=value" folder
    # (as written by partitionBy) names it by its value.
    section = F.when(F.size(parts) > 1, F.regexp_replace(F.element_at(parts, 1), "^[^=]*=", ""))
    d = files.withColumn("section", section).withColumn("__v", _parsed("value"))
    v = F.col("__v")
    # what parses but is no record cannot be loaded as one
    flat = v.isNotNull() & ~_is_object(F.try_variant_get(v, doc_path, "variant"))
    d = with_all_errors(d, "__v", {name: f"__err_{name}" for name in SECTION_CHECKS}, doc_path, False,
                        {name: F.col("section") == name for name in SECTION_CHECKS}, {"__none": v.isNull(), "__flat": flat})
    errs = F.lit(None).cast("array<string>")
    for name in SECTION_CHECKS:
        errs = F.when(F.col("section") == name, F.col(f"__err_{name}")).otherwise(errs)
    none, flat = F.col("__none"), F.col("__flat")
    return d.select(
        "file_path",
        "value",
        "section",
        F.when(none, F.lit("syntax")).when(flat, F.lit("loading")).otherwise(F.lit("validation")).alias("kind"),
        F.when(none, F.array(F.lit(INVALID_JSON))).when(flat, F.array(F.lit(NOT_A_RECORD)))
        .otherwise(F.coalesce(errs, F.array().cast("array<string>")))
        .alias("errors"),
    )


def error_report(checked: DataFrame, id_cols: tuple[str, ...], errors_col: str = "errors") -> DataFrame:
    """V9: one line per (record, kind/section, message).

    A section map is flattened to one array of (kind, message) pairs and
    exploded once, so the checks run once per record.
    """
    c = F.col(errors_col)
    if dict(checked.dtypes)[errors_col].startswith("map"):
        pairs = F.flatten(
            F.transform(
                F.map_entries(c),
                lambda e: F.transform(e["value"], lambda m: F.struct(e["key"].alias("kind"), m.alias("message"))),
            )
        )
        return checked.select(*id_cols, F.inline(pairs))
    kind = ["kind"] if "kind" in checked.columns else []
    return checked.select(*id_cols, *kind, messages(c))


def messages(errors: Column) -> Column:
    """``message``, a row for each of an array. From a plain column, ``explode`` would first
    filter by its size, and that filter runs every rule once more below the checks, with
    all their views written out in it."""
    return F.inline(F.transform(errors, lambda m: F.struct(m.alias("message"))))


def n_errors(checked: DataFrame, errors_col: str = "errors") -> Column:
    """Number of messages of a row (array or section map of arrays)."""
    c = F.col(errors_col)
    if dict(checked.dtypes)[errors_col].startswith("map"):
        return F.aggregate(F.map_values(c), F.lit(0), lambda acc, x: acc + F.size(x))
    return F.size(c)


def split_valid(checked: DataFrame, errors_col: str = "errors") -> tuple[DataFrame, DataFrame]:
    """V9: (valid, quarantined) rows."""
    n = n_errors(checked, errors_col)
    return checked.where(n == 0), checked.where(n > 0)


def all_valid(checked: DataFrame, errors_col: str = "errors") -> bool:
    """V9 gate: true only when no row has an error (a missing input is not valid)."""
    n = n_errors(checked, errors_col)
    row = checked.agg(F.count(F.lit(1)).alias("rows"), F.max(n).alias("worst")).first()
    return bool(row["rows"]) and (row["worst"] or 0) == 0


def check_config_files(spark: SparkSession, root: str) -> bool:
    """V9 over a folder; a folder that does not exist is not valid. Other
    failures (a lost executor, say) are raised."""
    from pyspark.errors import AnalysisException

    try:
        checked = check_files(spark, root)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return all_valid(checked)
