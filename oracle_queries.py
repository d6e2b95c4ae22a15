"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written independently of the Spark plans: the SQL ranks values with
``row_number`` over the whole group, zero-fills candidate x label grids
and routes rows level by level through long-format cells, which is how a
relational engine states the definitions directly.  The Spark side
instead uses distributed prefix sums, bucket numbers and the sparse
algebraic form of the right-hand sums.
"""

from __future__ import annotations

FILLER = "FILLER_STRING"
QUANTILES = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.9)
DIGITS = 9

# name -> (key, label, select, {feature: kind})
DATASETS = {
    "orders": (
        "o_orderkey",
        "o_orderstatus",
        "SELECT o_orderkey, o_orderstatus, o_totalprice, o_custkey, o_orderpriority FROM orders",
        {"o_totalprice": "ordinal", "o_custkey": "ordinal", "o_orderpriority": "categorical"},
    ),
    "lineitem": (
        "l_key",
        "l_returnflag",
        "SELECT l_orderkey * 10 + l_linenumber AS l_key, l_returnflag, l_quantity, l_linenumber, "
        "NULLIF(l_discount, 0.0) AS l_discount, l_tax, l_extendedprice, l_linestatus FROM lineitem",
        {"l_quantity": "ordinal", "l_linenumber": "ordinal", "l_discount": "ordinal", "l_tax": "ordinal",
         "l_extendedprice": "ordinal", "l_linestatus": "categorical"},
    ),
    "documents": (
        "doc_id",
        "quality",
        "SELECT d.doc_id, l.quality, d.n_chars, l.toxic, d.lang, d.source "
        "FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
        {"n_chars": "ordinal", "toxic": "ordinal", "lang": "categorical", "source": "categorical"},
    ),
    "documents_lang": (
        "doc_id",
        "lang",
        "SELECT doc_id, lang, lang AS same, n_chars FROM documents",
        {"same": "categorical", "n_chars": "ordinal"},
    ),
    "lineitem_nan": (
        "l_key",
        "l_returnflag",
        "SELECT l_orderkey * 10 + l_linenumber AS l_key, l_returnflag, "
        "CASE WHEN l_discount <= 0.04 THEN CAST('NaN' AS DOUBLE) ELSE l_discount END AS l_discount, l_tax FROM lineitem",
        {"l_discount": "ordinal", "l_tax": "ordinal"},
    ),
    "part_constant": (
        "p_partkey",
        "p_type",
        "SELECT p_partkey, p_type, CASE WHEN p_size >= 25 THEN 1 ELSE 0 END AS big, 'same' AS one, p_size, p_brand FROM part",
        {"big": "ordinal", "one": "categorical", "p_size": "ordinal", "p_brand": "categorical"},
    ),
    "documents_filled": (
        "doc_id",
        "lang",
        "SELECT doc_id, lang, lang AS same, source, n_chars FROM documents",
        {"same": "categorical", "source": "categorical", "n_chars": "ordinal"},
    ),
    "part": (
        "p_partkey",
        "p_type",
        "SELECT p_partkey, p_type, p_size, p_retailprice, p_brand FROM part",
        {"p_size": "ordinal", "p_retailprice": "ordinal", "p_brand": "categorical"},
    ),
}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _counts_union(table: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT {_q(c)} AS col, {c} AS value, count({c}) AS n FROM {table} GROUP BY {c}" for c in columns
    )


def keep_ctes(table: str, columns, min_count: int = 32, cap: int = 6, prefix: str = "") -> str:
    """``{prefix}keep(col, value)``: the kept values of every column."""
    return (
        f"{prefix}ccount AS ({_counts_union(table, columns)}), "
        f"{prefix}keep AS (SELECT col, value FROM (SELECT col, value, row_number() OVER "
        f"(PARTITION BY col ORDER BY n DESC, value ASC) AS rk FROM {prefix}ccount WHERE n >= {min_count}) "
        f"WHERE rk <= {cap})"
    )


def bucketed(column: str, keep: str = "keep", alias: str | None = None) -> str:
    alias = alias or column
    return (
        f"CASE WHEN {column} IN (SELECT value FROM {keep} WHERE col = {_q(column)}) "
        f"THEN {column} ELSE {_q(FILLER)} END AS {alias}"
    )


def prep_ctes(name: str, reference: bool = False, features=None, min_count: int = 32, cap: int = 6) -> tuple[str, dict]:
    """``base``, ``keep``, ``prep(rid, y, <features>)``, ``num``, ``cat``, ``lab``."""
    key, label, select, kinds = DATASETS[name]
    if features is not None:
        kinds = {f: kinds[f] for f in features}
    cats = [f for f, k in kinds.items() if k == "categorical"]
    nums = [f for f, k in kinds.items() if k == "ordinal"]
    label_is_string = name != "documents"
    to_keep = cats + ([label] if reference and label_is_string else [])
    parts = [f"base AS ({select})"]
    cols = ["row_number() OVER () AS rid", f"{key} AS k"]
    if to_keep:
        if reference:
            min_count, cap = 32, 6  # reference semantics bucket with the default settings
        parts.append(keep_ctes("base", to_keep, min_count, cap))
    if reference and label_is_string:
        cols.append(f"CAST(CASE WHEN {label} IN (SELECT value FROM keep WHERE col = {_q(label)}) "
                    f"THEN {label} ELSE {_q(FILLER)} END AS VARCHAR) AS y")
    else:
        cols.append(f"CAST({label} AS VARCHAR) AS y")
    cols += [f"CAST({f} AS DOUBLE) AS {f}" for f in nums]
    cols += [bucketed(f) for f in cats]
    parts.append(f"prep AS (SELECT {', '.join(cols)} FROM base WHERE {label} IS NOT NULL)")
    num = " UNION ALL ".join(f"SELECT rid, {_q(f)} AS feature, {f} AS x FROM prep" for f in nums) or (
        "SELECT CAST(NULL AS BIGINT) AS rid, CAST(NULL AS VARCHAR) AS feature, CAST(NULL AS DOUBLE) AS x WHERE false"
    )
    cat = " UNION ALL ".join(f"SELECT rid, {_q(f)} AS feature, {f} AS c FROM prep" for f in cats) or (
        "SELECT CAST(NULL AS BIGINT) AS rid, CAST(NULL AS VARCHAR) AS feature, CAST(NULL AS VARCHAR) AS c WHERE false"
    )
    parts.append(f"num AS ({num})")
    parts.append(f"cat AS ({cat})")
    parts.append("lab AS (SELECT rid, y FROM prep)")
    qs = ", ".join(f"({q})" for q in QUANTILES)
    parts.append(f"qs AS (SELECT CAST(q AS DOUBLE) AS q FROM (VALUES {qs}) v(q))")
    return ", ".join(parts), kinds


def _f(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def level_ctes(d: int, reference: bool = False) -> str:
    """Candidates of level ``d`` for the rows in ``a{d}(rid, node)``; defines
    ``sc{d}`` (every candidate with scores) and ``bs{d}`` (best per node)."""
    ref_tot = (
        f"ltf{d} AS (SELECT v.node, v.feature, l.y, count(*) AS tot FROM nv{d} v JOIN lab l ON l.rid = v.rid "
        f"GROUP BY v.node, v.feature, l.y), "
        f"og{d} AS (SELECT t.node, t.feature, t.t, t.mult, lt.y, lt.tot FROM thr{d} t JOIN ltf{d} lt "
        f"ON lt.node = t.node AND lt.feature = t.feature), "
        if reference
        else f"og{d} AS (SELECT t.node, t.feature, t.t, t.mult, lt.y, lt.tot FROM thr{d} t JOIN lt{d} lt ON lt.node = t.node), "
    )
    cl0 = "coalesce(o.cl, 0)"
    sums = (
        f"sum({cl0}) AS tl, sum(g.tot - {cl0}) AS tr, "
        f"sum(CAST({cl0} AS HUGEINT) * {cl0}) AS sl, "
        f"sum(CAST(g.tot - {cl0} AS HUGEINT) * (g.tot - {cl0})) AS sr"
    )
    gl = f"1.0 - {_f('sl')} / ({_f('tl')} * {_f('tl')})"
    gr = f"1.0 - {_f('sr')} / NULLIF({_f('tr')} * {_f('tr')}, 0.0)"
    g = (f"1.0 - ({_f('sl')} / NULLIF({_f('tl')}, 0.0) + {_f('sr')} / NULLIF({_f('tr')}, 0.0)) "
         f"/ {_f('tl + tr')}")
    if reference:
        m = _f("mult")
        gl, gr, g = (f"1.0 - (1.0 - ({x})) / {m}" for x in (gl, gr, g))
        nl, nr = "tl * mult", "tr * mult"
    else:
        nl, nr = "tl", "tr"
    return (
        f"nv{d} AS (SELECT a.rid, a.node, n.feature, n.x FROM a{d} a JOIN num n ON n.rid = a.rid WHERE n.x IS NOT NULL), "
        f"rk{d} AS (SELECT node, feature, x, row_number() OVER (PARTITION BY node, feature ORDER BY x) - 1 AS r, "
        f"count(*) OVER (PARTITION BY node, feature) AS n FROM nv{d}), "
        f"thr{d} AS (SELECT rk.node, rk.feature, rk.x AS t, count(*) AS mult FROM rk{d} rk JOIN qs "
        f"ON rk.r = CAST(floor((rk.n - 1) * qs.q + 0.5) AS BIGINT) GROUP BY rk.node, rk.feature, rk.x), "
        f"lt{d} AS (SELECT a.node, l.y, count(*) AS tot FROM a{d} a JOIN lab l ON l.rid = a.rid GROUP BY a.node, l.y), "
        f"ol{d} AS (SELECT t.node, t.feature, t.t, l.y, count(*) AS cl FROM thr{d} t JOIN nv{d} v "
        f"ON v.node = t.node AND v.feature = t.feature AND v.x >= t.t JOIN lab l ON l.rid = v.rid "
        f"GROUP BY t.node, t.feature, t.t, l.y), "
        + ref_tot
        + f"os{d} AS (SELECT g.node, g.feature, 'ordinal' AS kind, g.t AS threshold, CAST(NULL AS VARCHAR) AS category, "
        f"g.mult, {sums} FROM og{d} g LEFT JOIN ol{d} o ON o.node = g.node AND o.feature = g.feature "
        f"AND o.t = g.t AND o.y = g.y GROUP BY g.node, g.feature, g.t, g.mult), "
        f"cv{d} AS (SELECT a.rid, a.node, c.feature, c.c FROM a{d} a JOIN cat c ON c.rid = a.rid), "
        f"cl{d} AS (SELECT v.node, v.feature, v.c, l.y, count(*) AS cl FROM cv{d} v JOIN lab l ON l.rid = v.rid "
        f"WHERE v.c <> {_q(FILLER)} GROUP BY v.node, v.feature, v.c, l.y), "
        f"cc{d} AS (SELECT DISTINCT node, feature, c FROM cl{d}), "
        f"cg{d} AS (SELECT c.node, c.feature, c.c, lt.y, lt.tot FROM cc{d} c JOIN lt{d} lt ON lt.node = c.node), "
        f"cs{d} AS (SELECT g.node, g.feature, 'categorical' AS kind, CAST(NULL AS DOUBLE) AS threshold, g.c AS category, "
        f"CAST(1 AS BIGINT) AS mult, {sums} FROM cg{d} g LEFT JOIN cl{d} o ON o.node = g.node AND o.feature = g.feature "
        f"AND o.c = g.c AND o.y = g.y GROUP BY g.node, g.feature, g.c), "
        f"sc{d} AS (SELECT node, feature, kind, threshold, category, "
        f"CAST({nl} AS BIGINT) AS n_left, CAST({nr} AS BIGINT) AS n_right, "
        f"{gl} AS gini_left, {gr} AS gini_right, {g} AS child_gini "
        f"FROM (SELECT * FROM os{d} UNION ALL SELECT * FROM cs{d})), "
        f"bs{d} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY child_gini ASC NULLS LAST, "
        f"feature ASC, threshold ASC NULLS LAST, category ASC NULLS LAST) AS rn FROM sc{d} WHERE child_gini IS NOT NULL) "
        f"WHERE rn = 1)"
    )


def root_sql(name: str, select: str, reference: bool = False, features=None, tail: str = "") -> str:
    prep, _ = prep_ctes(name, reference, features)
    return f"WITH {prep}, a0 AS (SELECT rid, CAST(1 AS BIGINT) AS node FROM prep), {level_ctes(0, reference)} {select} {tail}"


def best_per_column(d: int = 0) -> str:
    return (
        f"bc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node, feature ORDER BY child_gini ASC NULLS LAST, "
        f"threshold ASC NULLS LAST, category ASC NULLS LAST) AS rn2 FROM sc{d}) WHERE rn2 = 1)"
    )


def tree_sql(name: str, max_depth: int = 4, min_leaf: int = 32, final: str = "", reference: bool = False) -> str:
    """Tree of ``max_depth`` levels; defines ``nodes`` (the node table),
    ``leafrows(rid, node, depth)`` and ``leaflab(node, depth, label, n_rows)``.

    Leaves are every child of a split that is not split itself, plus an
    unsplit root, so a child no row reaches (possible when reference
    routing differs from scoring) is still listed, with 0 rows.
    """
    prep, _ = prep_ctes(name, reference=reference, min_count=min_leaf)
    parts = [prep, "a0 AS (SELECT rid, CAST(1 AS BIGINT) AS node FROM prep)"]
    leaf_parts, inner_parts, kid_parts = [], [], ["SELECT CAST(1 AS BIGINT) AS node, 0 AS depth"]
    for d in range(max_depth):
        parts.append(level_ctes(d, reference))
        purity = "" if reference else " WHERE nl.n_labels > 1"
        op = ">" if reference else ">="
        test = (
            f"CASE WHEN s.kind = 'ordinal' THEN n.x {op} s.threshold ELSE c.c = s.category END"
            if reference
            else f"CASE WHEN s.kind = 'ordinal' THEN coalesce(n.x >= s.threshold, false) "
            f"ELSE coalesce(c.c = s.category, false) END"
        )
        parts.append(
            f"nl{d} AS (SELECT node, count(*) AS n_labels, CAST(sum(tot) AS BIGINT) AS n_rows FROM lt{d} GROUP BY node), "
            f"sp{d} AS (SELECT b.*, nl.n_rows FROM bs{d} b JOIN nl{d} nl ON nl.node = b.node{purity}), "
            f"sd{d} AS (SELECT a.rid, s.node, s.n_left, s.n_right, {test} AS go_left "
            f"FROM a{d} a JOIN sp{d} s ON s.node = a.node "
            f"LEFT JOIN num n ON n.rid = a.rid AND n.feature = s.feature "
            f"LEFT JOIN cat c ON c.rid = a.rid AND c.feature = s.feature), "
            f"ch{d} AS (SELECT rid, CASE WHEN go_left THEN 2 * node ELSE 2 * node + 1 END AS node, "
            f"CASE WHEN go_left THEN n_left ELSE n_right END AS scored FROM sd{d} WHERE go_left IS NOT NULL), "
            f"a{d + 1} AS (SELECT rid, node FROM ch{d} WHERE {d + 1} < {max_depth} AND scored >= {min_leaf}), "
            f"lf{d} AS (SELECT rid, node, {d} AS depth FROM a{d} WHERE node NOT IN (SELECT node FROM sp{d}) "
            f"UNION ALL SELECT rid, node, {d + 1} AS depth FROM ch{d} WHERE NOT ({d + 1} < {max_depth} AND scored >= {min_leaf}))"
        )
        leaf_parts.append(f"SELECT * FROM lf{d}")
        inner_parts.append(
            f"SELECT node AS node_id, {d} AS depth, false AS is_leaf, feature, kind, threshold, category, "
            f"n_left, n_right, n_rows, CAST(NULL AS VARCHAR) AS label, child_gini FROM sp{d}"
        )
        kid_parts.append(f"SELECT 2 * node AS node, {d + 1} AS depth FROM sp{d} UNION ALL "
                         f"SELECT 2 * node + 1, {d + 1} FROM sp{d}")
    if max_depth == 0:
        leaf_parts.append("SELECT rid, node, 0 AS depth FROM a0")
    split_nodes = " UNION ALL ".join(f"SELECT node FROM sp{d}" for d in range(max_depth)) or (
        "SELECT CAST(NULL AS BIGINT) AS node WHERE false"
    )
    parts.append(f"leafrows AS ({' UNION ALL '.join(leaf_parts)})")
    parts.append(
        "leafcnt AS (SELECT l.node, b.y, count(*) AS cnt FROM leafrows l JOIN lab b ON b.rid = l.rid "
        "GROUP BY l.node, b.y), "
        "leafmode AS (SELECT node, y AS label, n_rows FROM (SELECT node, y, cnt, "
        "CAST(sum(cnt) OVER (PARTITION BY node) AS BIGINT) AS n_rows, "
        "row_number() OVER (PARTITION BY node ORDER BY cnt DESC, y ASC) AS rn FROM leafcnt) WHERE rn = 1), "
        f"kids AS ({' UNION ALL '.join(kid_parts)}), "
        f"leaflab AS (SELECT k.node, k.depth, m.label, CAST(coalesce(m.n_rows, 0) AS BIGINT) AS n_rows FROM kids k "
        f"LEFT JOIN leafmode m ON m.node = k.node WHERE k.node NOT IN ({split_nodes}))"
    )
    leaves = (
        "SELECT node AS node_id, depth, true AS is_leaf, CAST(NULL AS VARCHAR) AS feature, CAST(NULL AS VARCHAR) AS kind, "
        "CAST(NULL AS DOUBLE) AS threshold, CAST(NULL AS VARCHAR) AS category, CAST(NULL AS BIGINT) AS n_left, "
        "CAST(NULL AS BIGINT) AS n_right, n_rows, label, CAST(NULL AS DOUBLE) AS child_gini FROM leaflab"
    )
    parts.append(f"nodes AS ({' UNION ALL '.join(inner_parts + [leaves])})")
    return "WITH " + ", ".join(parts) + " " + final


def _r(x: str, alias: str | None = None) -> str:
    return f"round({x}, {DIGITS}) AS {alias or x}"


ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["category_counts"] = (
    "SELECT col AS \"column\", value, n FROM ("
    + _counts_union("part", ["p_name", "p_brand", "p_type"])
    + ") WHERE value IS NOT NULL"
)

ORACLE_SQL["top_categories"] = (
    f"WITH c AS ({_counts_union('documents', ['lang', 'source'])}) "
    "SELECT col AS \"column\", value, n, CAST(rk AS INTEGER) AS rank FROM (SELECT col, value, n, row_number() OVER "
    "(PARTITION BY col ORDER BY n DESC, value ASC) AS rk FROM c WHERE n >= 32) WHERE rk <= 6"
)

ORACLE_SQL["droppable_columns"] = (
    f"WITH {keep_ctes('customer', ['c_name', 'c_mktsegment'])} "
    "SELECT c AS \"column\" FROM (VALUES ('c_name'), ('c_mktsegment')) v(c) WHERE c NOT IN (SELECT col FROM keep)"
)

ORACLE_SQL["bucket_rare_categories"] = (
    f"WITH {keep_ctes('part', ['p_name', 'p_brand', 'p_type'])} "
    f"SELECT p_partkey, {bucketed('p_name')}, {bucketed('p_brand')}, {bucketed('p_type')}, p_size, p_retailprice FROM part"
)

ORACLE_SQL["prepare_frame"] = (
    f"WITH {keep_ctes('part', ['p_brand'])} "
    f"SELECT CAST(p_type AS VARCHAR) AS p_type, p_size, p_retailprice, {bucketed('p_brand')} FROM part "
    "WHERE p_type IS NOT NULL"
)

ORACLE_SQL["class_histogram"] = root_sql(
    "orders",
    ", hb AS (SELECT v.node AS node_id, v.feature, 'ordinal' AS kind, "
    "CAST((SELECT count(*) FROM thr0 t WHERE t.node = v.node AND t.feature = v.feature AND v.x >= t.t) AS INTEGER) AS bucket, "
    "CAST(NULL AS VARCHAR) AS category, l.y AS label FROM nv0 v JOIN lab l ON l.rid = v.rid "
    "UNION ALL SELECT v.node, v.feature, 'categorical', CAST(NULL AS INTEGER), v.c, l.y FROM cv0 v JOIN lab l ON l.rid = v.rid) "
    "SELECT node_id, feature, kind, bucket, category, label, count(*) AS cnt FROM hb "
    "GROUP BY node_id, feature, kind, bucket, category, label",
).replace(" , hb AS", ", hb AS")

ORACLE_SQL["nearest_rank_quantiles"] = (
    "WITH cells AS ("
    + " UNION ALL ".join(
        f"SELECT CAST(l_linenumber AS BIGINT) AS node_id, {_q(f)} AS feature, CAST({f} AS DOUBLE) AS x FROM lineitem"
        for f in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    )
    + "), rk AS (SELECT node_id, feature, x, row_number() OVER (PARTITION BY node_id, feature ORDER BY x) - 1 AS r, "
    "count(*) OVER (PARTITION BY node_id, feature) AS n FROM cells WHERE x IS NOT NULL), "
    "qs AS (SELECT CAST(q_index AS INTEGER) AS q_index, CAST(q AS DOUBLE) AS quantile FROM (VALUES "
    + ", ".join(f"({i}, {q})" for i, q in enumerate(QUANTILES))
    + ") v(q_index, q)) "
    "SELECT rk.node_id, rk.feature, qs.q_index, qs.quantile, rk.x AS threshold FROM rk JOIN qs "
    "ON rk.r = CAST(floor((rk.n - 1) * qs.quantile + 0.5) AS BIGINT)"
)

ORACLE_SQL["label_totals_window"] = root_sql(
    "lineitem",
    ", h AS (SELECT v.node AS node_id, v.feature, v.c AS category, l.y AS label, count(*) AS cnt FROM cv0 v "
    "JOIN lab l ON l.rid = v.rid GROUP BY v.node, v.feature, v.c, l.y) "
    "SELECT node_id, feature, category, label, cnt, CAST(sum(cnt) OVER (PARTITION BY feature, label) AS BIGINT) AS label_total, "
    "CAST(sum(cnt) OVER (PARTITION BY feature, label) - cnt AS BIGINT) AS cnt_out FROM h",
    features=["l_linestatus"],
).replace(" , h AS", ", h AS")

ORACLE_SQL["majority_label"] = (
    "WITH c AS (SELECT o_orderpriority, o_orderstatus, count(*) AS cnt FROM orders GROUP BY o_orderpriority, o_orderstatus) "
    "SELECT o_orderpriority, label, cnt, n_rows FROM (SELECT o_orderpriority, o_orderstatus AS label, cnt, "
    "CAST(sum(cnt) OVER (PARTITION BY o_orderpriority) AS BIGINT) AS n_rows, row_number() OVER (PARTITION BY o_orderpriority "
    "ORDER BY cnt DESC, o_orderstatus ASC) AS rn FROM c) WHERE rn = 1"
)

ORACLE_SQL["categorical_in_out_counts"] = root_sql(
    "documents",
    " SELECT g.feature, g.c AS category, g.y AS label, coalesce(o.cl, 0) AS cnt_in, g.tot - coalesce(o.cl, 0) AS cnt_out "
    "FROM cg0 g LEFT JOIN cl0 o ON o.node = g.node AND o.feature = g.feature AND o.c = g.c AND o.y = g.y",
    features=["lang", "source"],
)

ORACLE_SQL["ordinal_in_out_counts"] = root_sql(
    "lineitem",
    " SELECT g.feature, g.t AS threshold, g.y AS label, coalesce(o.cl, 0) AS cnt_in, g.tot - coalesce(o.cl, 0) AS cnt_out "
    "FROM og0 g LEFT JOIN ol0 o ON o.node = g.node AND o.feature = g.feature AND o.t = g.t AND o.y = g.y",
    features=["l_quantity", "l_discount", "l_tax"],
)

ORACLE_SQL["candidate_totals"] = root_sql(
    "lineitem", " SELECT feature, kind, threshold, category, n_left, n_right FROM sc0"
)

ORACLE_SQL["gini_per_side"] = root_sql(
    "lineitem", f" SELECT feature, kind, threshold, category, {_r('gini_left')}, {_r('gini_right')} FROM sc0"
)

ORACLE_SQL["weighted_gini"] = root_sql(
    "documents", f" SELECT feature, kind, threshold, category, n_left, n_right, {_r('child_gini')} FROM sc0"
)

ORACLE_SQL["best_categorical_split"] = root_sql(
    "orders",
    f" SELECT feature, kind, category AS selection, n_left, n_right, {_r('child_gini')} FROM bs0",
    features=["o_orderpriority"],
)

ORACLE_SQL["best_ordinal_split"] = root_sql(
    "orders",
    f" SELECT feature, kind, threshold, n_left, n_right, {_r('child_gini')} FROM bs0",
    features=["o_totalprice"],
)

ORACLE_SQL["best_split_per_column"] = root_sql(
    "part",
    f", {best_per_column()} SELECT feature, kind, threshold, category, n_left, n_right, {_r('child_gini')} FROM bc",
).replace(" , bc AS", ", bc AS")


def _ranked_sql(name: str, reference: bool = False) -> str:
    return root_sql(
        name,
        f", {best_per_column()} SELECT CAST(row_number() OVER (ORDER BY child_gini ASC NULLS LAST, feature ASC, "
        f"threshold ASC NULLS LAST, category ASC NULLS LAST) AS INTEGER) AS rank, feature, kind, threshold, category, "
        f"n_left, n_right, {_r('child_gini')} FROM bc",
        reference=reference,
    ).replace(" , bc AS", ", bc AS")


ORACLE_SQL["rank_columns_by_gini"] = _ranked_sql("documents")
ORACLE_SQL["rank_columns_by_gini_reference"] = _ranked_sql("lineitem", reference=True)

ORACLE_SQL["informative_columns"] = root_sql(
    "documents", ", bc2 AS (SELECT DISTINCT feature, kind FROM sc0 WHERE child_gini IS NOT NULL) SELECT feature, kind FROM bc2"
).replace(" , bc2 AS", ", bc2 AS")

ORACLE_SQL["fit_node_table"] = tree_sql(
    "lineitem", 4, 32,
    "SELECT node_id, CASE WHEN node_id = 1 THEN NULL ELSE node_id // 2 END AS parent_id, CAST(depth AS INTEGER) AS depth, "
    "is_leaf, feature, kind, threshold, category, n_left, n_right, n_rows, label, "
    f"{_r('child_gini')} FROM nodes",
)

ORACLE_SQL["fit_node_table_reference"] = tree_sql(
    "lineitem", 3, 32,
    "SELECT node_id, CASE WHEN node_id = 1 THEN NULL ELSE node_id // 2 END AS parent_id, CAST(depth AS INTEGER) AS depth, "
    "is_leaf, feature, kind, threshold, category, n_left, n_right, n_rows, label, "
    f"{_r('child_gini')} FROM nodes",
    reference=True,
)

ORACLE_SQL["predict_reference"] = tree_sql(
    "lineitem", 3, 32,
    "SELECT p.k AS l_key, l.label AS PREDICTED_LABEL FROM leafrows r JOIN leaflab l ON l.node = r.node "
    "JOIN prep p ON p.rid = r.rid",
    reference=True,
)

ORACLE_SQL["leaf_labels"] = tree_sql("orders", 3, 32, "SELECT node AS node_id, label, n_rows FROM leaflab")

ORACLE_SQL["predict_depth2"] = tree_sql(
    "orders", 2, 32,
    "SELECT p.k AS o_orderkey, l.label AS PREDICTED_LABEL FROM leafrows r JOIN leaflab l ON l.node = r.node "
    "JOIN prep p ON p.rid = r.rid",
)

ORACLE_SQL["leaf_assignment"] = tree_sql(
    "documents", 3, 10, "SELECT p.k AS doc_id, r.node AS node_id FROM leafrows r JOIN prep p ON p.rid = r.rid"
)

ORACLE_SQL["split_left_right"] = tree_sql(
    "part", 1, 32,
    "SELECT p.k AS p_partkey, CASE WHEN s.go_left THEN 'left' ELSE 'right' END AS side FROM sd0 s "
    "JOIN prep p ON p.rid = s.rid",
)



def rule_ctes(max_depth: int) -> str:
    """``rules(node, rule)``: the tests on the path to every node."""
    parts = ["ru0 AS (SELECT CAST(1 AS BIGINT) AS node, '' AS rule)"]
    for d in range(max_depth):
        sides = [
            f"SELECT 2 * s.node{plus} AS node, CASE WHEN r.rule = '' THEN '' ELSE r.rule || ' AND ' END || s.feature || "
            f"CASE WHEN s.kind = 'ordinal' THEN ' {num} ' || CAST(s.threshold AS VARCHAR) "
            f"ELSE ' {cat} ''' || s.category || '''' END AS rule FROM sp{d} s JOIN ru{d} r ON r.node = s.node"
            for plus, num, cat in (("", ">=", "="), (" + 1", "<", "!="))
        ]
        parts.append(f"ru{d + 1} AS ({' UNION ALL '.join(sides)})")
    union = " UNION ALL ".join(f"SELECT * FROM ru{d}" for d in range(max_depth + 1))
    return ", ".join(parts) + f", rules AS ({union})"


ORACLE_SQL["leaf_rule_stats"] = tree_sql(
    "lineitem", 2, 32,
    f", {rule_ctes(2)}, lr AS (SELECT r.node, count(*) AS n_rows, sum(CASE WHEN b.y = l.label THEN 1 ELSE 0 END) AS n_correct "
    "FROM leafrows r JOIN lab b ON b.rid = r.rid JOIN leaflab l ON l.node = r.node GROUP BY r.node) "
    "SELECT l.node AS node_id, u.rule, l.label, coalesce(lr.n_rows, 0) AS n_rows, "
    "CAST(coalesce(lr.n_correct, 0) AS BIGINT) AS n_correct "
    "FROM leaflab l JOIN rules u ON u.node = l.node LEFT JOIN lr ON lr.node = l.node",
).replace(" , ru0 AS", ", ru0 AS")

ORACLE_SQL["leaf_label_mix"] = tree_sql("lineitem", 2, 32, "SELECT node AS node_id, y AS actual, cnt FROM leafcnt")

ORACLE_SQL["predict_join_route"] = tree_sql(
    "orders", 5, 32,
    "SELECT p.k AS o_orderkey, l.label AS PREDICTED_LABEL FROM leafrows r JOIN leaflab l ON l.node = r.node "
    "JOIN prep p ON p.rid = r.rid",
)

ORACLE_SQL["sparse_in_out_counts"] = root_sql(
    "documents_lang",
    " SELECT g.feature, CAST(NULL AS DOUBLE) AS threshold, g.c AS category, g.y AS label, coalesce(o.cl, 0) AS cnt_in, "
    "g.tot - coalesce(o.cl, 0) AS cnt_out FROM cg0 g LEFT JOIN cl0 o "
    "ON o.node = g.node AND o.feature = g.feature AND o.c = g.c AND o.y = g.y "
    "UNION ALL SELECT g.feature, g.t, CAST(NULL AS VARCHAR), g.y, coalesce(o.cl, 0), g.tot - coalesce(o.cl, 0) "
    "FROM og0 g LEFT JOIN ol0 o ON o.node = g.node AND o.feature = g.feature AND o.t = g.t AND o.y = g.y",
)


def _nan_sql(reference: bool) -> str:
    return root_sql(
        "lineitem_nan",
        " SELECT feature, isnan(threshold) AS nan_threshold, CASE WHEN NOT isnan(threshold) THEN threshold END AS threshold, "
        f"n_left, n_right, {_r('child_gini')} FROM sc0",
        reference=reference,
    )


ORACLE_SQL["candidates_nan"] = _nan_sql(False)
ORACLE_SQL["candidates_nan_reference"] = _nan_sql(True)

ORACLE_SQL["best_split_unsigned"] = root_sql(
    "orders",
    f" SELECT feature, kind, threshold, CAST(threshold AS VARCHAR) AS selection, n_left, n_right, {_r('child_gini')} FROM bs0",
    features=["o_custkey"],
)

_NODE_TABLE = (
    "SELECT node_id, CASE WHEN node_id = 1 THEN NULL ELSE node_id // 2 END AS parent_id, CAST(depth AS INTEGER) AS depth, "
    "is_leaf, feature, kind, threshold, category, n_left, n_right, n_rows, label, "
    f"{_r('child_gini')} FROM nodes"
)

ORACLE_SQL["fit_pruned_node_table"] = tree_sql("part_constant", 4, 20, _NODE_TABLE)
ORACLE_SQL["fit_deep_node_table"] = tree_sql("orders", 12, 400, _NODE_TABLE)

# A path's tests, walked up from the leaf one parent at a time.
ORACLE_SQL["leaf_boxes"] = tree_sql(
    "lineitem", 3, 32,
    ", up AS (SELECT node_id AS leaf, node_id // 2 AS at, node_id % 2 = 0 AS lft FROM nodes WHERE is_leaf AND node_id > 1 "
    "UNION ALL SELECT node_id, node_id // 4, (node_id // 2) % 2 = 0 FROM nodes WHERE is_leaf AND node_id > 3 "
    "UNION ALL SELECT node_id, node_id // 8, (node_id // 4) % 2 = 0 FROM nodes WHERE is_leaf AND node_id > 7) "
    "SELECT u.leaf AS node_id, n.feature, n.kind, max(n.threshold) FILTER (u.lft) AS lo, min(n.threshold) FILTER (NOT u.lft) AS hi, "
    "max(n.category) FILTER (u.lft) AS category, "
    "CASE WHEN max(n.category) FILTER (u.lft) IS NULL THEN string_agg(DISTINCT n.category, ',' ORDER BY n.category) FILTER (NOT u.lft) END AS excluded, "
    "max(l.n_rows) AS n_rows FROM up u JOIN nodes n ON n.node_id = u.at JOIN nodes l ON l.node_id = u.leaf "
    "GROUP BY u.leaf, n.feature, n.kind",
).replace(" , up AS", ", up AS")

ORACLE_SQL["predict_indexed"] = tree_sql(
    "orders", 2, 32,
    "SELECT p.k AS o_orderkey, row_number() OVER (ORDER BY o.o_totalprice DESC, o.o_orderkey) - 1 AS row_index, "
    "l.label AS PREDICTED_LABEL FROM leafrows r JOIN leaflab l ON l.node = r.node JOIN prep p ON p.rid = r.rid "
    "JOIN orders o ON o.o_orderkey = p.k",
)

ORACLE_SQL["zero_filled_histogram"] = root_sql(
    "documents_filled",
    " SELECT g.feature, 'categorical' AS kind, CAST(NULL AS DOUBLE) AS threshold, g.c AS category, g.y AS label, "
    "coalesce(o.cl, 0) AS cnt, g.tot AS label_total FROM cg0 g LEFT JOIN cl0 o "
    "ON o.node = g.node AND o.feature = g.feature AND o.c = g.c AND o.y = g.y "
    "UNION ALL SELECT g.feature, 'ordinal', g.t, CAST(NULL AS VARCHAR), g.y, coalesce(o.cl, 0), g.tot "
    "FROM og0 g LEFT JOIN ol0 o ON o.node = g.node AND o.feature = g.feature AND o.t = g.t AND o.y = g.y",
)

ORACLE_SQL["frame_diff"] = (
    "WITH a AS (SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, 0 AS place FROM orders), "
    "changed AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 89 = 0 THEN '?' ELSE o_orderstatus END AS o_orderstatus, "
    "CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice * 1.0000000001::DOUBLE WHEN o_orderkey % 97 = 0 THEN o_totalprice + 1.5::DOUBLE "
    "ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 101 <> 0), "
    "twice AS (SELECT * FROM changed UNION ALL SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 211 = 0), "
    # What is equal on both sides cancels out, copy by copy; the rest is ranked per key.
    "numbered AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderkey, o_orderstatus, o_totalprice) AS copy FROM twice), "
    "left_rest AS (SELECT a.* FROM a LEFT JOIN numbered n ON n.o_custkey = a.o_custkey AND n.o_orderkey = a.o_orderkey "
    "AND n.o_orderstatus = a.o_orderstatus AND n.o_totalprice = a.o_totalprice AND n.copy = 1 WHERE n.copy IS NULL), "
    "right_rest AS (SELECT n.o_custkey, n.o_orderkey, n.o_orderstatus, n.o_totalprice, row_number() OVER (PARTITION BY n.o_custkey, n.o_orderkey "
    "ORDER BY n.o_orderstatus, n.o_totalprice) - 1 AS place FROM numbered n LEFT JOIN a ON n.o_custkey = a.o_custkey "
    "AND n.o_orderkey = a.o_orderkey AND n.o_orderstatus = a.o_orderstatus AND n.o_totalprice = a.o_totalprice AND n.copy = 1 "
    "WHERE a.place IS NULL), "
    "pairs AS (SELECT coalesce(x.o_custkey, y.o_custkey) AS o_custkey, coalesce(x.o_orderkey, y.o_orderkey) AS o_orderkey, "
    "CAST(coalesce(x.place, y.place) AS INTEGER) AS place, x.o_orderkey AS xk, y.o_orderkey AS yk, x.o_orderstatus AS xs, "
    "y.o_orderstatus AS ys, x.o_totalprice AS xp, y.o_totalprice AS yp FROM left_rest x FULL JOIN right_rest y "
    "ON x.o_custkey = y.o_custkey AND x.o_orderkey = y.o_orderkey AND x.place = y.place) "
    "SELECT o_custkey, o_orderkey, place, 'left_only' AS status, CAST(NULL AS VARCHAR) AS \"column\", CAST(NULL AS VARCHAR) AS left_value, "
    "CAST(NULL AS VARCHAR) AS right_value FROM pairs WHERE yk IS NULL "
    "UNION ALL SELECT o_custkey, o_orderkey, place, 'right_only', NULL, NULL, NULL FROM pairs WHERE xk IS NULL "
    "UNION ALL SELECT o_custkey, o_orderkey, place, 'differs', 'o_orderstatus', xs, ys FROM pairs WHERE xk = yk AND xs <> ys "
    "UNION ALL SELECT o_custkey, o_orderkey, place, 'differs', 'o_totalprice', CAST(xp AS VARCHAR), CAST(yp AS VARCHAR) FROM pairs "
    "WHERE xk = yk AND NOT abs(xp - yp) <= 1e-8 + 1e-5 * abs(yp)"
)

ORACLE_SQL["csv_inferred"] = (
    "SELECT *, CAST(2 AS BIGINT) AS n_bad, 'c_custkey bigint, c_name string, c_nationkey bigint, c_acctbal double, c_mktsegment string' "
    "AS types FROM (SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer)"
)
