"""The same results as ANSI SQL over the same tables, for DuckDB.

Vectors are kept long, one row per element; positions come from one global
``row_number``, which the engine itself never uses. Doubles are compared at six
decimals.
"""

from __future__ import annotations

import math

from linkloom.functions.names import ENDING_PATTERN, ONLY_ENDINGS
from linkloom.registry.fixtures import FEATURE_SEED, KEYS, MODEL_SEED, RUN, WIDE, WIDE_LAYER, WIDTHS

K = ", ".join(KEYS)
BRONZE = f"{K}, src_id, dst_id, Purchaser, Seller"
ENDINGS = "[' LLC', ', Ltd.', ' Inc', '']"
PATTERN = ENDING_PATTERN.removeprefix("(?i)")


def digest(seed: int, *keys: str) -> str:
    return f"md5(concat_ws(':', {', '.join(keys)}, {seed}))"


def unit(text: str, start: int = 1) -> str:
    return f"(('0x' || substr({text}, {start}, 8))::BIGINT / 4294967296.0::DOUBLE)"


def fine_unit(text: str, start: int = 1) -> str:
    return f"(('0x' || substr({text}, {start}, 13))::BIGINT / 4503599627370496.0::DOUBLE)"


def draw(seed: int, *keys: str) -> str:
    return unit(digest(seed, *keys))


def normal(seed: int, *keys: str) -> str:
    d = digest(seed, *keys)
    return f"(sqrt(-2.0 * ln(1.0::DOUBLE - {unit(d)})) * cos({2.0 * math.pi!r} * {unit(d, 9)}))"


def r6(e: str) -> str:
    return f"(CASE WHEN round({e}, 6) = 0 THEN 0.0::DOUBLE ELSE round({e}, 6)::DOUBLE END)"


def base(e: str) -> str:
    stripped = f"regexp_replace(trim({e}), '{PATTERN}', '', 'i')"
    return f"CASE WHEN regexp_matches(trim({e}), '{ONLY_ENDINGS}') THEN trim({e}) ELSE {stripped} END"


def sigmoid(e: str) -> str:
    return f"(1.0::DOUBLE / (1.0 + exp(-({e}))))"


def elements(value: str, n: int, prefix: str, pos: str = "pos") -> str:
    """Pivot a long vector to rounded columns."""
    return ", ".join(f"{r6(f'max(CASE WHEN {pos} = {i} THEN {value} END)')} AS {prefix}{i}" for i in range(n))


# Named pieces: (SQL, names it needs). Only what a query needs is put in front of it.
PIECES: dict[str, tuple[str, tuple[str, ...]]] = {}


def piece(name: str, sql: str, *needs: str) -> None:
    PIECES[name] = (sql, needs)


def sql(final: str, *needs: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for n in PIECES[name][1]:
                visit(n)
            ordered.append(name)

    for n in needs:
        visit(n)
    if not ordered:
        return final
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({PIECES[n][0]})" for n in ordered) + "\n" + final


piece(
    "bronze",
    f"""SELECT {K}, o_custkey AS src_id,
       l_suppkey + (SELECT max(c_custkey) FROM customer) + 1 AS dst_id,
       c_name || {ENDINGS}[l_orderkey % 4 + 1] AS Purchaser,
       s_name || {ENDINGS}[l_linenumber % 4 + 1] AS Seller,
       {draw(1, *KEYS)} AS probability
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey""",
)
piece(
    "silver",
    f"""SELECT {K}, src_id, dst_id, {base('Purchaser')} AS Purchaser, {base('Seller')} AS Seller, probability
FROM bronze WHERE probability >= 0.55::DOUBLE""",
    "bronze",
)
piece(
    "predictions",
    f"SELECT *, CASE WHEN l_linenumber <> 7 THEN {draw(2, *KEYS)} END AS gnn_prediction FROM bronze",
    "bronze",
)
piece(
    "placed",
    f"SELECT row_number() OVER (ORDER BY {K}) - 1 AS eid, src_id AS src, dst_id AS dst FROM silver",
    "silver",
)
piece(
    "edges",
    """SELECT eid, src, dst,
       CASE WHEN eid < n - valid - test THEN 'training'
            WHEN eid < n - test THEN 'validation' ELSE 'testing' END AS split
FROM placed, (SELECT count(*) AS n, floor(0.1::DOUBLE * count(*))::BIGINT AS test,
                     floor(0.2::DOUBLE * count(*))::BIGINT AS valid FROM placed)""",
    "placed",
)
piece("n_nodes", "SELECT max(greatest(src, dst)) + 1 AS n FROM edges", "edges")
piece("nodes", "SELECT unnest(range(0, n)) AS id FROM n_nodes", "n_nodes")
piece(
    "x",
    f"""SELECT id, pos, {normal(FEATURE_SEED, 'id', 'pos')} AS v
FROM nodes, (SELECT unnest(range(0, {WIDTHS[0]})) AS pos)""",
    "nodes",
)
piece(
    "wide_x",
    f"""SELECT id, pos, {normal(FEATURE_SEED, 'id', 'pos')} AS v
FROM nodes, (SELECT unnest(range(0, {WIDE[0]})) AS pos)""",
    "nodes",
)
piece(
    "batched",
    f"""SELECT *, (row_number() OVER (ORDER BY {draw(RUN.seed, 'eid')}, eid) - 1) // {RUN.batch_size} AS batch_id
FROM edges""",
    "edges",
)
piece(
    "scores",
    f"""SELECT batch_id, eid, split, ({draw(21, 'eid')} < 0.5)::INTEGER AS label,
       (floor({draw(22, 'eid')} * 20) - 10) / 5.0::DOUBLE AS score FROM batched""",
    "batched",
)
piece("skewed", f"SELECT {K}, -2 * ln(1 - probability) - 0.5 AS v FROM bronze", "bronze")
piece(
    "spread",
    """SELECT count(*) AS n, stddev_samp(v) AS sd, quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.75) AS q75,
quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS iqr FROM skewed""",
    "skewed",
)
piece(
    "numbers",
    """SELECT id, row_number() OVER (ORDER BY nth, id) - 1 AS number FROM (
SELECT id, min(nth) AS nth FROM (
SELECT unnest([src_id, dst_id]) AS id, CASE WHEN l_linenumber <= 3 THEN 0 ELSE 1 END AS nth FROM bronze
) GROUP BY id)""",
    "bronze",
)
piece("links", "SELECT src, dst, count(*) AS n FROM edges GROUP BY src, dst", "edges")


def _weights() -> None:
    def grid(layer: int, part: str, n_out: int, n_in: int) -> str:
        w = draw(MODEL_SEED, str(layer), f"'{part}'", "o", "i")
        return f"""SELECT {layer} AS layer, '{part}' AS part, o, i, {w} - 0.5 AS w
FROM (SELECT unnest(range(0, {n_out})) AS o), (SELECT unnest(range(0, {n_in})) AS i)"""

    grids = []
    sizes = [*enumerate(zip(WIDTHS, WIDTHS[1:]), start=1), (WIDE_LAYER, WIDE)]
    for nth, (n_in, n_out) in sizes:
        grids += [grid(nth, "self", n_out, n_in), grid(nth, "neigh", n_out, n_in)]
        grids += [grid(nth, "bias", n_out, 1)]
        grids += [grid(nth, "pool", n_in, n_in), grid(nth, "pool_bias", n_in, 1)]
    grids += [grid(3, "head", 1, 2 * WIDTHS[2]), grid(3, "bias", 1, 1)]
    piece("w", "\nUNION ALL ".join(grids))


_weights()


def apply_weights(source: str, layer: int, part: str, keys: str = "id") -> str:
    """``weight @ v`` of a long vector table."""
    return f"""SELECT {keys}, o AS pos, sum(w * v) AS v FROM {source} JOIN w ON i = pos
WHERE layer = {layer} AND part = '{part}' GROUP BY {keys}, o"""


def pooled_inputs(name: str, source: str, layer: int, keys: str = "id") -> None:
    piece(
        name,
        f"""SELECT {keys}, pos, greatest(0.0, v + b.w) AS v FROM ({apply_weights(source, layer, 'pool', keys)})
JOIN w b ON b.layer = {layer} AND b.part = 'pool_bias' AND b.o = pos""",
        source,
        "w",
    )


def layer_pieces(
    name: str, links: str, source: str, layer: int, kind: str, activate: bool, batch: bool = False
) -> None:
    """Pieces ``<name>_agg`` and ``<name>`` for one convolution of long vectors."""
    key, on = ("batch_id, ", "l.batch_id = s.batch_id AND ") if batch else ("", "")
    lkey = "l.batch_id, " if batch else ""
    messages = source
    if kind != "mean":
        messages = f"{name}_q"
        pooled_inputs(messages, source, layer, f"{key}id")
    fold = "max(s.v)" if kind == "pool" else "sum(s.v * l.n) / sum(l.n)"
    piece(
        f"{name}_agg",
        f"""SELECT {lkey}l.dst AS id, s.pos, {fold} AS v FROM {links} l
JOIN {messages} s ON {on}s.id = l.src GROUP BY {lkey}l.dst, s.pos""",
        links,
        messages,
    )
    total = "sum(v) + any_value(w)"
    out = f"greatest(0.0, {total})" if activate else total
    piece(
        name,
        f"""SELECT {key}id, pos, {out} AS v FROM (
{apply_weights(source, layer, 'self', f'{key}id')} UNION ALL
{apply_weights(f'{name}_agg', layer, 'neigh', f'{key}id')})
JOIN w ON layer = {layer} AND part = 'bias' AND o = pos GROUP BY {key}id, pos""",
        source,
        f"{name}_agg",
        "w",
    )


for _kind in ("mean", "pool", "mean_pool"):
    layer_pieces(f"h1_{_kind}", "links", "x", 1, _kind, True)
for _kind in ("mean", "pool"):
    layer_pieces(f"wide_{_kind}", "links", "wide_x", WIDE_LAYER, _kind, True)
for _kind in ("mean", "pool"):
    layer_pieces(f"h2_{_kind}", "links", f"h1_{_kind}", 2, _kind, True)
layer_pieces("emb", "links", "h1_mean", 2, "mean", False)


def shares(name: str, source: str, keys: str = "id") -> None:
    d = WIDTHS[2]
    piece(
        name,
        f"""SELECT {keys}, sum(CASE WHEN i < {d} AND i = pos THEN w * v END) AS as_src,
       sum(CASE WHEN i >= {d} AND i - {d} = pos THEN w * v END) AS as_dst
FROM {source} JOIN w ON layer = 3 AND part = 'head' GROUP BY {keys}""",
        source,
        "w",
    )


shares("emb_shares", "emb")
HEAD_BIAS = "(SELECT w FROM w WHERE layer = 3 AND part = 'bias')"
MLP = f"u.as_src + v.as_dst + {HEAD_BIAS}"
piece(
    "scored",
    f"""SELECT b.*, {sigmoid(MLP)} AS gnn_prediction FROM bronze b
LEFT JOIN emb_shares u ON u.id = src_id LEFT JOIN emb_shares v ON v.id = dst_id""",
    "bronze",
    "emb_shares",
)


# Sampled batches


def slot_pieces(name: str, edges: str) -> None:
    piece(
        f"{name}_slots",
        f"SELECT dst, src, eid, row_number() OVER (PARTITION BY dst ORDER BY eid) - 1 AS slot FROM {edges}",
        edges,
    )
    piece(f"{name}_degrees", f"SELECT dst, count(*) AS degree FROM {edges} GROUP BY dst", edges)


def neighbour_pieces(name: str, seeds: str, slots: str, layer: int, fanout: int = 4) -> None:
    """``fanout`` distinct slots: a taken number is replaced by the newest one."""
    columns = []
    for i in range(fanout):
        last = f"(degree - {fanout - i})"
        u = fine_unit(digest(RUN.seed, str(layer), "batch_id", "dst", str(i // 2)), 13 * (i % 2) + 1)
        t = f"floor({u} * ({last} + 1))::BIGINT"
        columns.append(f"{t} AS t{i}")
        taken = ", ".join(f"c{j}" for j in range(i))
        columns.append(f"CASE WHEN t{i} IN ({taken}) THEN {last} ELSE t{i} END AS c{i}" if i else "t0 AS c0")
    chosen = ", ".join(f"c{i}" for i in range(fanout))
    piece(
        name,
        f"""SELECT p.batch_id, p.dst, s.src, s.eid FROM (
  SELECT batch_id, dst, unnest(CASE WHEN degree > {fanout} THEN [{chosen}] ELSE range(0, degree) END) AS slot
  FROM (SELECT batch_id, dst, degree, {', '.join(columns)}
        FROM {seeds} JOIN {slots}_degrees ON dst = id)) p
JOIN {slots}_slots s ON s.dst = p.dst AND s.slot = p.slot""",
        seeds,
        f"{slots}_slots",
        f"{slots}_degrees",
    )


def negatives(source: str, k: int, seed: int, extra: str = "") -> str:
    """Corruptions; the draw's bound is the node count."""
    return f"""SELECT eid, nth, src, floor({fine_unit(digest(seed, 'eid', 'nth'))} * n)::BIGINT AS dst{extra}
FROM {source}, (SELECT unnest(range(0, {k}))::INTEGER AS nth), n_nodes"""


SPLITS = {"tr": "training", "va": "validation", "te": "testing"}


def each_split(text: str) -> str:
    """``text`` for all three splits, stacked; ``{s}`` and ``{split}`` name one."""
    filled = [
        text.replace("{split}", split).replace("{s}", s).replace("{negatives}", negatives(f"{s}_edges", 1, 7))
        for s, split in SPLITS.items()
    ]
    return "\nUNION ALL ".join(filled)


slot_pieces("all", "edges")
piece("batch_ends", "SELECT DISTINCT batch_id, dst AS id FROM batched", "batched")
neighbour_pieces("batch_neighbours", "batch_ends", "all", 1)

for _split in ("training", "validation", "testing"):
    s = _split[:2]
    piece(f"{s}_edges", f"SELECT eid, src, dst FROM edges WHERE split = '{_split}'", "edges")
    slot_pieces(s, f"{s}_edges")
    piece(
        f"{s}_pos",
        f"""SELECT *, (row_number() OVER (ORDER BY {draw(RUN.seed, 'eid')}, eid) - 1) // {RUN.batch_size} AS batch_id
FROM {s}_edges""",
        f"{s}_edges",
    )
    piece(
        f"{s}_pairs",
        f"""SELECT batch_id, eid, -1 AS nth, src, dst, 1 AS label FROM {s}_pos UNION ALL
SELECT batch_id, eid, nth, src, dst, 0 FROM ({negatives(f'{s}_pos', RUN.num_negative_samples, RUN.seed, ', batch_id')})""",
        f"{s}_pos",
        "n_nodes",
    )
    piece(
        f"{s}_seeds",
        f"SELECT batch_id, src AS id FROM {s}_pairs UNION SELECT batch_id, dst FROM {s}_pairs",
        f"{s}_pairs",
    )
    neighbour_pieces(f"{s}_outer", f"{s}_seeds", s, 2)
    piece(
        f"{s}_reached",
        f"SELECT batch_id, id FROM {s}_seeds UNION SELECT batch_id, src FROM {s}_outer",
        f"{s}_seeds",
        f"{s}_outer",
    )
    neighbour_pieces(f"{s}_inner", f"{s}_reached", s, 1)
    piece(
        f"{s}_x",
        f"""SELECT batch_id, id, pos, v FROM (SELECT batch_id, id FROM {s}_reached UNION
SELECT batch_id, src FROM {s}_inner) JOIN x USING (id)""",
        f"{s}_reached",
        f"{s}_inner",
        "x",
    )
    for _hop in ("inner", "outer"):
        piece(f"{s}_{_hop}_n", f"SELECT batch_id, src, dst, 1 AS n FROM {s}_{_hop}", f"{s}_{_hop}")
    layer_pieces(f"{s}_h1", f"{s}_inner_n", f"{s}_x", 1, "mean", True, batch=True)
    layer_pieces(f"{s}_h2", f"{s}_outer_n", f"{s}_h1", 2, "mean", False, batch=True)
    shares(f"{s}_shares", f"{s}_h2", "batch_id, id")
    piece(
        f"{s}_scores",
        f"""SELECT p.batch_id, p.eid, p.nth, p.label, '{_split}' AS split, {MLP} AS score FROM {s}_pairs p
JOIN {s}_shares u ON u.batch_id = p.batch_id AND u.id = p.src
JOIN {s}_shares v ON v.batch_id = p.batch_id AND v.id = p.dst""",
        f"{s}_pairs",
        f"{s}_shares",
    )


# Metrics


def ranking(source: str, group: str) -> str:
    """``auc`` and ``ap`` per group from per-score counts."""
    g = ", ".join(f"c.{c.strip()}" for c in group.split(","))
    return f"""SELECT {g},
  CASE WHEN max(p) > 0 AND max(q) > 0
       THEN sum(pos * (neg_before + neg * 0.5::DOUBLE)) / (max(p)::DOUBLE * max(q)) END AS auc,
  CASE WHEN max(p) > 0 THEN sum(pos::DOUBLE / nullif(p, 0)
       * ((p - pos_before)::DOUBLE / (p - pos_before + q - neg_before))) END AS ap
FROM (SELECT *, sum(pos) OVER g AS p, sum(neg) OVER g AS q,
        coalesce(sum(pos) OVER b, 0) AS pos_before, coalesce(sum(neg) OVER b, 0) AS neg_before
      FROM (SELECT {group}, score, sum(label) AS pos, sum(1 - label) AS neg
            FROM {source} GROUP BY {group}, score)
      WINDOW g AS (PARTITION BY {group}),
             b AS (PARTITION BY {group} ORDER BY score
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) c
GROUP BY {g}"""


BCE = "avg(greatest(score, 0.0) - score * label + ln(1.0 + exp(-abs(score))))"


def place(key: str, seed: int) -> str:
    return f"round(45.0 + {draw(seed, key)}, 6) AS lat, round(9.0 + {draw(seed + 1, key)}, 6) AS lon"


piece("patients", f"SELECT c_custkey AS id, c_acctbal AS score, {place('c_custkey', 31)} FROM customer")
piece(
    "providers",
    f"SELECT s_suppkey + (SELECT max(c_custkey) FROM customer) + 1 AS id, {place('s_suppkey', 33)} FROM supplier",
)


def _bronze(where: str = "") -> str:
    return sql(f"SELECT {BRONZE}, {r6('probability')} AS probability FROM bronze {where}", "bronze")


def _h(source: str, width: int) -> str:
    return sql(f"SELECT id, {elements('v', width, 'h')} FROM {source} GROUP BY id", source)


def _agg(source: str) -> str:
    return sql(
        f"SELECT id AS dst, {elements('v', WIDTHS[0], 'm')} FROM {source} GROUP BY id", source
    )


def oracle_queries() -> dict[str, str]:
    d0 = WIDTHS[0]
    half_lat, half_lon = "pow(sin(radians(q.lat - p.lat) / 2.0), 2)", "pow(sin(radians(q.lon - p.lon) / 2.0), 2)"
    km = f"(12742.0 * asin(sqrt(least({half_lat} + cos(radians(p.lat)) * cos(radians(q.lat)) * {half_lon}, 1.0))))"
    silver = sql(f"SELECT {BRONZE}, {r6('probability')} AS probability FROM silver", "silver")
    predicted = f"{r6('gnn_prediction')} AS gnn_prediction"
    refined = "CASE WHEN gnn_prediction >= probability THEN gnn_prediction ELSE probability END"
    return {
        "land_archive": _bronze(),
        "read_landing_stream": _bronze(),
        "append_stream": "SELECT event_id, user_id, value FROM events WHERE value >= 50",
        "evolve_schema": sql(
            f"""SELECT {K}, src_id, dst_id, Purchaser,
CASE WHEN l_linenumber > 3 THEN Seller END AS Seller, {r6('probability')} AS probability FROM bronze""",
            "bronze",
        ),
        "csv_to_table": "SELECT c_custkey AS id, c_acctbal AS score FROM customer",
        "read_table": sql("SELECT src_id, dst_id, Purchaser, Seller FROM silver", "silver"),
        "stream_table": sql("SELECT src_id, dst_id FROM bronze", "bronze"),
        "overwrite_table": sql(f"SELECT {K} FROM bronze WHERE probability >= 0.55::DOUBLE", "bronze"),
        "preview": _bronze(f"ORDER BY {K} LIMIT 10"),
        "edge_table": sql("SELECT src_id, dst_id FROM bronze", "bronze"),
        "confident_links": _bronze("WHERE probability >= 0.55::DOUBLE"),
        "low_confidence_links": _bronze("WHERE probability < 0.55::DOUBLE"),
        "clean_parties": sql(
            f"SELECT {K}, {base('Purchaser')} AS Purchaser, {base('Seller')} AS Seller FROM bronze", "bronze"
        ),
        "triage_candidates": sql(
            f"""SELECT Purchaser, Seller, {r6('probability')} AS probability, {predicted} FROM predictions
WHERE gnn_prediction > probability AND gnn_prediction > 0.8::DOUBLE AND probability < 0.6::DOUBLE""",
            "predictions",
        ),
        "refine_probability": sql(
            f"SELECT {BRONZE}, {r6(refined)} AS probability FROM predictions", "predictions"
        ),
        "base_names": sql(
            f"""SELECT {base('name')} AS base, count(*) AS n
FROM (SELECT Purchaser AS name FROM bronze UNION ALL SELECT Seller FROM bronze) GROUP BY 1""",
            "bronze",
        ),
        "draw_numbers": f"""SELECT {K}, {r6(draw(1, *KEYS))} AS u, {r6(normal(1, *KEYS))} AS z FROM lineitem""",
        "sigmoid": sql(f"SELECT eid, {r6(sigmoid('score'))} AS p FROM scores", "scores"),
        "relu": f"""SELECT vec_id, (i - 1)::INTEGER AS pos, {r6('greatest(0.0, embedding[i]::DOUBLE)')} AS value
FROM embeddings, (SELECT unnest(range(1, 65)) AS i) WHERE i <= len(embedding)""",
        "dot": f"""SELECT vec_id, {r6('sum(embedding[i]::DOUBLE * embedding[i]::DOUBLE)')} AS norm2,
{r6('sum(embedding[i]::DOUBLE * embedding[65 - i]::DOUBLE)')} AS folded
FROM embeddings, (SELECT unnest(range(1, 65)) AS i) GROUP BY vec_id""",
        "linear": sql(
            f"""SELECT id, {elements('v + w', WIDTHS[1], 'y')}
FROM ({apply_weights('x', 1, 'self')}) JOIN w ON layer = 1 AND part = 'bias' AND o = pos GROUP BY id""",
            "x",
            "w",
        ),
        "linear_wide": sql(
            f"""SELECT id, {elements('v + w', WIDE[1], 'y')}
FROM ({apply_weights('wide_x', WIDE_LAYER, 'self')}) JOIN w ON layer = {WIDE_LAYER} AND part = 'bias' AND o = pos GROUP BY id""",
            "wide_x",
            "w",
        ),
        "sage_layer_wide": _h("wide_mean", WIDE[1]),
        "sage_layer_pool_wide": _h("wide_pool", WIDE[1]),
        "positional_index": f"SELECT {K}, row_number() OVER (ORDER BY {K}) - 1 AS pos FROM lineitem",
        "running_totals": """SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, n,
coalesce(sum(n) OVER (ORDER BY o_orderdate ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS n_before
FROM (SELECT o_orderdate, count(*) AS n FROM orders GROUP BY o_orderdate)""",
        "split_edges": sql("SELECT eid, src, dst, split FROM edges", "edges"),
        "assign_batches": sql("SELECT eid, batch_id FROM batched", "batched"),
        "node_batches": sql(
            f"""SELECT id, (row_number() OVER (ORDER BY {draw(RUN.seed, 'id')}, id) - 1) // {RUN.batch_size} AS batch_id
FROM nodes""",
            "nodes",
        ),
        "cap_steps": sql(f"SELECT eid, batch_id FROM batched WHERE batch_id <= {RUN.max_steps}", "batched"),
        "sample_fraction": sql(
            f"""SELECT id FROM (SELECT id, row_number() OVER (ORDER BY {draw(5, 'id')}, id) - 1 AS place FROM nodes)
WHERE place < (SELECT round_even(0.3::DOUBLE * count(*), 0) FROM nodes)""",
            "nodes",
        ),
        "build_graph": sql("SELECT eid, src, dst FROM placed", "placed"),
        "graph_summary": sql("SELECT n AS n_nodes, (SELECT count(*) FROM edges) AS n_edges FROM n_nodes", "n_nodes"),
        "node_set": sql(
            """SELECT id, (id IN (SELECT src FROM edges UNION SELECT dst FROM edges))::INTEGER AS touched FROM nodes""",
            "nodes",
            "edges",
        ),
        "degree_profile": sql(
            """SELECT direction, degree, count(*) AS n_nodes FROM (
SELECT direction, node, count(*) AS degree FROM (
SELECT 'out' AS direction, src AS node FROM edges UNION ALL SELECT 'in', dst FROM edges)
GROUP BY direction, node) GROUP BY direction, degree""",
            "edges",
        ),
        "node_features": sql(f"SELECT id, {elements('v', d0, 'x')} FROM x GROUP BY id", "x"),
        "gather_features": sql(
            f"SELECT eid, {elements('v', d0, 'x')} FROM edges JOIN x ON id = src GROUP BY eid", "edges", "x"
        ),
        "endpoint_pairs": sql(
            f"""SELECT eid, {elements('u.v', d0, 'u', 'u.pos')}, {elements('t.v', d0, 'v', 't.pos')}
FROM edges JOIN x u ON u.id = src JOIN x t ON t.id = dst AND t.pos = u.pos GROUP BY eid""",
            "edges",
            "x",
        ),
        "frontier": sql(
            each_split("SELECT eid, src, dst, '{split}' AS split FROM edges WHERE dst IN (SELECT dst FROM ({negatives}))"),
            "edges",
            *[f"{s}_edges" for s in SPLITS],
            "n_nodes",
        ),
        "negative_edges": sql(negatives("edges", 3, 7, ", split"), "edges", "n_nodes"),
        "strict_negatives": sql(
            f"""SELECT eid, nth, src, dst FROM ({negatives('edges', 3, 7)}) g
WHERE NOT EXISTS (SELECT 1 FROM links e WHERE e.src = g.src AND e.dst = g.dst)""",
            "edges",
            "links",
            "n_nodes",
        ),
        "label_and_stack": sql(
            f"""SELECT eid, src, dst, 1 AS label, split FROM edges UNION ALL
SELECT eid, src, dst, 0, split FROM ({negatives('edges', 3, 7, ', split')})""",
            "edges",
            "n_nodes",
        ),
        "sample_neighbours": sql("SELECT batch_id, dst, src, eid FROM batch_neighbours", "batch_neighbours"),
        "sample_blocks": sql(
            each_split(
                """SELECT batch_id, 2 AS layer, dst, src, eid, '{split}' AS split FROM {s}_outer UNION ALL
SELECT batch_id, 1, dst, src, eid, '{split}' FROM {s}_inner"""
            ),
            *[f"{s}_{x}" for s in SPLITS for x in ("outer", "inner")],
        ),
        "edge_batch_sizes": sql(
            each_split(
                """SELECT batch_id, n_pos::BIGINT AS n_pos, n_neg::BIGINT AS n_neg, n_seeds,
coalesce(n_inner, 0) AS n_inner, coalesce(n_outer, 0) AS n_outer, '{split}' AS split
FROM (SELECT batch_id, sum(label) AS n_pos, sum(1 - label) AS n_neg FROM {s}_pairs GROUP BY batch_id)
JOIN (SELECT batch_id, count(*) AS n_seeds FROM {s}_seeds GROUP BY batch_id) USING (batch_id)
LEFT JOIN (SELECT batch_id, count(*) AS n_inner FROM {s}_inner GROUP BY batch_id) USING (batch_id)
LEFT JOIN (SELECT batch_id, count(*) AS n_outer FROM {s}_outer GROUP BY batch_id) USING (batch_id)"""
            ),
            *[f"{s}_{x}" for s in SPLITS for x in ("inner", "outer")],
        ),
        "neighbour_mean": _agg("h1_mean_agg"),
        "neighbour_mean_stored": sql(
            f"""SELECT dst, (i - 1)::INTEGER AS pos, {r6('avg(embedding[i]::DOUBLE)')} AS m
FROM edges JOIN embeddings ON vec_id = src % (SELECT count(*) FROM embeddings),
(SELECT unnest(range(1, 65)) AS i) GROUP BY dst, i""",
            "edges",
        ),
        "neighbour_pool": _agg("h1_pool_agg"),
        "neighbour_mean_pool": _agg("h1_mean_pool_agg"),
        "sage_layer": _h("h1_mean", WIDTHS[1]),
        "sage_layer_pool": _h("h1_pool", WIDTHS[1]),
        "sage_layer_mean_pool": _h("h1_mean_pool", WIDTHS[1]),
        "embed_all": _h("h2_mean", WIDTHS[2]),
        "fresh_embeddings": _h("h2_mean", WIDTHS[2]),
        "embed_all_pool": _h("h2_pool", WIDTHS[2]),
        "mlp_link_score": sql(
            f"""SELECT eid, {r6(MLP)} AS score FROM edges
JOIN emb_shares u ON u.id = src JOIN emb_shares v ON v.id = dst""",
            "edges",
            "emb_shares",
        ),
        "dot_link_score": sql(
            f"""SELECT eid, {r6(sigmoid('sum(u.v * t.v)'))} AS score
FROM edges JOIN x u ON u.id = src JOIN x t ON t.id = dst AND t.pos = u.pos GROUP BY eid""",
            "edges",
            "x",
        ),
        "forward": sql(
            each_split(f"SELECT split, batch_id, eid, nth, label, {r6('score')} AS score FROM {{s}}_scores"),
            *[f"{s}_scores" for s in SPLITS],
        ),
        "predict_links": sql(
            f"SELECT {K}, {predicted} FROM scored WHERE probability >= 0.55::DOUBLE", "scored"
        ),
        "predict_all_links": sql(
            f"""SELECT {K}, {base('Purchaser')} AS Purchaser, {base('Seller')} AS Seller, {predicted} FROM scored""",
            "scored",
        ),
        "first_slice": sql(
            f"""SELECT {BRONZE}, {r6('greatest(probability, gnn)')} AS probability FROM (
SELECT {BRONZE}, any_value(probability) AS probability, {sigmoid('sum(u.v * t.v)')} AS gnn
FROM (SELECT *, row_number() OVER () AS r FROM silver)
JOIN h1_mean u ON u.id = src_id JOIN h1_mean t ON t.id = dst_id AND t.pos = u.pos
GROUP BY r, {BRONZE})""",
            "silver",
            "h1_mean",
        ),
        "bce_loss": sql(f"SELECT split, {r6(BCE)} AS bce_loss FROM scores GROUP BY split", "scores"),
        "margin_loss": sql(
            f"""SELECT split, {r6(f"avg(greatest(0.0, {sigmoid(draw(23, 'eid', 'nth') + ' - 0.5')} - {sigmoid('score')} + 1.0))")} AS margin_loss
FROM scores, (SELECT unnest(range(0, 3)) AS nth) GROUP BY split""",
            "scores",
        ),
        "roc_auc": sql(f"SELECT split, {r6('auc')} AS auc FROM ({ranking('scores', 'split')})", "scores"),
        "average_precision": sql(
            f"SELECT split, {r6('ap')} AS ap FROM ({ranking('scores', 'split')})", "scores"
        ),
        "batch_metrics": sql(
            f"SELECT batch_id, {r6('auc')} AS auc, {r6('ap')} AS ap FROM ({ranking('scores', 'batch_id')})",
            "scores",
        ),
        "mean_batch_metric": sql(
            f"""SELECT split, {r6('avg(auc)')} AS mean_auc, {r6('avg(ap)')} AS mean_ap
FROM ({ranking('scores', 'split, batch_id')}) GROUP BY split""",
            "scores",
        ),
        "step_metrics": sql(
            f"""SELECT 'run' AS run_id, batch_id AS step, name, {r6('value')} AS value FROM (
SELECT batch_id, 'loss' AS name, {BCE} AS value FROM scores GROUP BY batch_id UNION ALL
SELECT batch_id, 'auc', auc FROM ({ranking('scores', 'batch_id')}) UNION ALL
SELECT batch_id, 'ap', ap FROM ({ranking('scores', 'batch_id')})) WHERE value IS NOT NULL""",
            "scores",
        ),
        "score_distribution": sql(
            f"""SELECT bin, n, {r6('n * 20 / sum(n) OVER ()::DOUBLE')} AS density FROM (
SELECT least(floor(probability * 20), 19)::BIGINT AS bin, count(*) AS n FROM bronze GROUP BY 1)""",
            "bronze",
        ),
        "score_quartiles": f"""SELECT n, {r6('q[1]')} AS q25, {r6('q[2]')} AS q50, {r6('q[3]')} AS q75,
{r6('q[1] - 1.5 * (q[3] - q[1])')} AS low_fence, {r6('q[3] + 1.5 * (q[3] - q[1])')} AS high_fence,
(SELECT count(*) FROM lineitem WHERE l_extendedprice < q[1] - 1.5 * (q[3] - q[1])
   OR l_extendedprice > q[3] + 1.5 * (q[3] - q[1])) AS n_outlying
FROM (SELECT count(*) AS n, quantile_cont(l_extendedprice, [0.25, 0.5, 0.75]) AS q FROM lineitem)""",
        "best_trial": sql(
            f"""SELECT trial_id, 'trial-' || trial_id AS params, {r6('loss')} AS loss FROM (
SELECT batch_id % 20 AS trial_id, -avg(auc) AS loss FROM ({ranking('scores', 'batch_id')}) GROUP BY 1)
ORDER BY loss, trial_id LIMIT 1""",
            "scores",
        ),
        "recommend_top_k": sql(
            f"""SELECT src_id, dst_id, {r6('probability')} AS probability, rank::INTEGER AS rank FROM (
SELECT *, row_number() OVER (PARTITION BY src_id ORDER BY probability DESC, dst_id) AS rank FROM (
SELECT src_id, dst_id, max(probability) AS probability FROM bronze GROUP BY src_id, dst_id))
WHERE rank <= 3""",
            "bronze",
        ),
        "unscored_links": _bronze("WHERE probability < 0.55::DOUBLE"),
        "enrich": sql(
            f"""SELECT {K}, src_id, dst_id, p.score, q.lat, q.lon FROM bronze
LEFT JOIN patients p ON p.id = src_id LEFT JOIN providers q ON q.id = dst_id""",
            "bronze",
            "patients",
            "providers",
        ),
        "archive_stream": sql(f"SELECT {BRONZE}, {r6('probability')} AS probability FROM bronze", "bronze"),
        "widening_records": sql(
            f"""SELECT {K}, CASE WHEN l_linenumber <= 2 THEN floor(probability * 10) WHEN l_linenumber <= 5 THEN {r6('probability')} END AS score,
l_linenumber > 5 AS aside FROM bronze""",
            "bronze",
        ),
        "company_endings": "SELECT c_custkey, c_name AS name FROM customer",
        "encode_ids": sql(
            f"""SELECT {K}, s.number AS src, t.number AS dst FROM bronze
JOIN numbers s ON s.id = src_id JOIN numbers t ON t.id = dst_id""",
            "bronze",
            "numbers",
        ),
        "refresh_table": sql(f"SELECT {K}, {r6('1 - probability')} AS probability FROM bronze WHERE probability >= 0.55::DOUBLE", "bronze"),
        "score_density": sql(
            """SELECT (i / 50.0)::DOUBLE AS x, round(sum(exp(-0.5 * pow((i / 50.0 - v) / width, 2))) / (max(n) * max(width) * sqrt(2 * pi())), 4)::DOUBLE + 0.0 AS density
FROM (SELECT v, n, 0.9 * least(sd, iqr / 1.34) * pow(n, -0.2) AS width FROM skewed, spread), range(0, 251) t(i)
GROUP BY i""",
            "skewed",
            "spread",
        ),
        "outlying_rows": sql(
            f"""SELECT {K}, {r6('v')} AS v FROM skewed, spread WHERE v < q25 - 1.5 * iqr OR v > q75 + 1.5 * iqr""",
            "skewed",
            "spread",
        ),
        "candidate_links": sql(
            """SELECT src, dst, score::BIGINT AS score, rank::INTEGER AS rank FROM (
SELECT *, row_number() OVER (PARTITION BY src ORDER BY score DESC, dst) AS rank FROM (
SELECT l.src, c.w AS dst, sum(c.n) AS score FROM links l JOIN (
SELECT a.dst AS v, b.dst AS w, count(*) AS n FROM links a JOIN links b ON a.src = b.src AND a.dst <> b.dst GROUP BY ALL
) c ON c.v = l.dst GROUP BY ALL
) s WHERE NOT EXISTS (SELECT 1 FROM links l WHERE l.src = s.src AND l.dst = s.dst)) WHERE rank <= 5""",
            "links",
        ),
        "nearest_providers": sql(
            f"""SELECT src_id, dst_id, {r6('km')} AS km, rank::INTEGER AS rank FROM (
SELECT *, row_number() OVER (PARTITION BY src_id ORDER BY km, dst_id) AS rank FROM (
SELECT p.id AS src_id, q.id AS dst_id, {km} AS km FROM patients p CROSS JOIN providers q)) WHERE rank <= 3""",
            "patients",
            "providers",
        ),
        "unlinked_pairs": sql(
            """SELECT DISTINCT src_id AS src, dst_id AS dst FROM bronze WHERE probability < 0.55::DOUBLE
AND src_id IN (SELECT src FROM edges UNION SELECT dst FROM edges)
AND dst_id IN (SELECT src FROM edges UNION SELECT dst FROM edges)
AND NOT EXISTS (SELECT 1 FROM links WHERE src = src_id AND dst = dst_id)""",
            "bronze",
            "edges",
            "links",
        ),
        "nearby_links": sql(
            f"""SELECT {K}, {r6('km')} AS km FROM (SELECT {K}, {km} AS km FROM bronze
JOIN patients p ON p.id = src_id JOIN providers q ON q.id = dst_id) WHERE km <= 40.0::DOUBLE""",
            "bronze",
            "patients",
            "providers",
        ),
        "bronze_stream": _bronze(),
        "silver_stream": silver,
        "score_stream": sql(f"SELECT {K}, {predicted} FROM scored", "scored"),
        "incremental_gold": sql(f"SELECT {K}, {r6(refined)} AS probability FROM scored", "scored"),
        "evaluate": sql(
            f"""SELECT split, {r6('avg(auc)')} AS mean_auc, {r6('avg(ap)')} AS mean_ap FROM ({ranking('both_scores', 'split, batch_id')})
GROUP BY split""",
            "both_scores",
        ),
    }


piece("both_scores", "SELECT * FROM va_scores UNION ALL SELECT * FROM te_scores", "va_scores", "te_scores")
