"""Building blocks for the DuckDB oracle SQL of the query registry.

DuckDB's regex engine has no look-behind, so sentence splitting marks each
"terminator + whitespace" with a private-use character and splits on it. The
marker is only applied to text that has already been whitespace-cleaned (one
U+0020 between words), which is what every X-stage after X1 sees. Every stage
materialises its sentence list ``s`` in its own CTE before lambdas use it.
"""

from __future__ import annotations

# Python's str.isspace() set written as an RE2 class:
# U+0009-000D, U+001C-0020, U+0085, U+00A0, U+1680, U+2000-200A, U+2028,
# U+2029, U+202F, U+205F, U+3000.
WS = (
    r"[\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
MARK = "chr(57344)"


def clean(expr: str) -> str:
    """X1 in DuckDB."""
    return f"trim(regexp_replace({expr}, '{WS}', ' ', 'g'))"


def split_clean(expr: str) -> str:
    """X2 in DuckDB for cleaned text."""
    return f"string_split(regexp_replace({expr}, '([.!?]) ', '\\1' || {MARK}, 'g'), {MARK})"


# Stage expressions over a CTE that has the cleaned text ``t`` and its
# sentence list ``s`` (for X3: the list of the first n + 100 characters).
def truncate_expr(n: int) -> str:
    """Sentence i (1-based) is kept while sum(length + 1) - 1 <= n over
    sentences 1..i; the first sentence needs length + 1 <= n."""
    kept = (
        f"CASE WHEN length(s[1]) + 1 > {n} THEN 0 ELSE length(list_filter(range(1, len(s) + 1), "
        f"lambda i: list_sum(list_transform(s[1:i], lambda x: length(x) + 1)) - 1 <= {n})) END"
    )
    return f"CASE WHEN length(t) <= {n} THEN t ELSE trim(array_to_string(s[1:{kept}], ' ')) END"


COMPLETE_EXPR = (
    "CASE WHEN regexp_matches(s[-1], '[.!?]$') THEN t "
    "ELSE array_to_string(s[1:len(s) - 1], ' ') END"
)
DEDUP_EXPR = "array_to_string(list_filter(s, lambda x, i: i = 1 OR x <> s[i - 1]), ' ')"


def post_process_ctes(src: str, keep: str, n: int | None, complete: bool, dedup: bool,
                      text: str = "text", prefix: str = "pp") -> tuple[str, str]:
    """X6 as a CTE chain over ``src``; returns (ctes, final cte name).

    ``keep`` lists the carried columns (comma separated); the processed text
    is column ``t`` of the final CTE.
    """
    ctes = [f"{prefix}0 AS (SELECT {keep}, {clean(text)} AS t FROM {src})"]
    i = 0

    def stage(split_of: str, expr: str) -> None:
        nonlocal i
        ctes.append(
            f"{prefix}{i}s AS (SELECT {keep}, t, {split_clean(split_of)} AS s FROM {prefix}{i})"
        )
        ctes.append(f"{prefix}{i + 1} AS (SELECT {keep}, {expr} AS t FROM {prefix}{i}s)")
        i += 1

    if n is not None:
        stage(f"substr(t, 1, {n + 100})", truncate_expr(n))
    if complete:
        stage("t", COMPLETE_EXPR)
    if dedup:
        stage("t", DEDUP_EXPR)
    return ",\n".join(ctes), f"{prefix}{i}"


def tokens_clean(t: str) -> str:
    """Whitespace tokens of cleaned text."""
    return f"list_filter(string_split({t}, ' '), lambda x: x <> '')"


def tokens_raw(t: str) -> str:
    """Whitespace tokens of raw text (Python ``str.split()``)."""
    return f"list_filter(regexp_split_to_array({t}, '{WS}'), lambda x: x <> '')"


def diversity_select(hist: str, group: str) -> str:
    """M2 over a histogram relation with columns (group..., tok, c)."""
    g = f"{group}, " if group else ""
    gb = f" GROUP BY {group}" if group else ""
    return (
        f"SELECT {g}count(*)::BIGINT AS unique_tokens, sum(c)::BIGINT AS total_tokens, "
        f"round(CASE WHEN sum(c) > 0 THEN count(*) / sum(c) ELSE 0 END, 6) AS unique_ratio, "
        f"round(CASE WHEN sum(c) > 0 THEN log2(sum(c)) - sum(c * log2(c)) / sum(c) ELSE 0 END, 6) "
        f"AS entropy FROM {hist}{gb}"
    )
