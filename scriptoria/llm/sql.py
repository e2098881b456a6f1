"""SQL of queries that repeat a step a fixed number of times, so that it is put together here."""

from __future__ import annotations

_CRC = "xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], [ascii(c)::BIGINT FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]), lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))))"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _climb(name: str, levels: int, fanout: int) -> str:
    """From `name`0 (grp, idx, total, digest): `name`1 and so on, each with the digests left and right of a node in its run."""
    out = []
    run = f"(PARTITION BY grp, idx // {fanout} ORDER BY idx ROWS BETWEEN"
    for j in range(levels):
        out.append(
            f"{name}{j}s AS (SELECT *, CASE WHEN total > 1 THEN coalesce(string_agg(digest, '') OVER {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') ELSE '' END AS l,"
            f" CASE WHEN total > 1 THEN coalesce(string_agg(digest, '') OVER {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') ELSE '' END AS r FROM {name}{j})"
        )
        out.append(
            f"{name}{j + 1} AS (SELECT grp, idx // {fanout} AS idx, any_value((total + {fanout - 1}) // {fanout}) AS total,"
            f" CASE WHEN any_value(total) > 1 THEN sha256(string_agg(digest, '' ORDER BY idx)) ELSE any_value(digest) END AS digest FROM {name}{j} GROUP BY grp, idx // {fanout})"
        )
    return ", ".join(out)


def merkle(levels: int = 5, upper: int = 3, fanout: int = 16) -> str:
    """The manifest of documents, for groups of up to fanout ** levels rows and fanout ** upper groups."""
    part = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"
    leaf = lambda text: "sha256(" + " || ".join(map(part, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    bent = f"CASE WHEN {_CRC} % 5 = 0 THEN translate(text, '{_UPPER}', '{_UPPER.lower()}') ELSE text END"
    steps, proof, joins = [], [], []
    for t, n, key in (("n", levels, "d.grp"), ("u", upper, "''")):
        at = "d.idx" if t == "n" else "d.place"
        for j in range(n):
            joins.append(f"JOIN {t}{j}s ON {t}{j}s.grp = {key} AND {t}{j}s.idx = {at} // {fanout**j}")
            proof.append(f"{t}{j}s.l || {t}{j}s.r")
            steps.append(f"{t}{j}")
    folds, last = [], "p0"
    for i, name in enumerate(steps):
        folds.append(f"p{i + 1} AS (SELECT * REPLACE (CASE WHEN {name}_total > 1 THEN sha256({name}_l || held || {name}_r) ELSE held END AS held) FROM {last})")
        last = f"p{i + 1}"
    carried = ", ".join(f"{s}s.total AS {s}_total, {s}s.l AS {s}_l, {s}s.r AS {s}_r" for s in steps)
    return f"""
        WITH a AS (
            SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS grp, {leaf("text")} AS leaf, {leaf(f"({bent})")} AS held FROM documents
        ), d0 AS (
            SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY grp) AS total FROM a
        ), n0 AS (SELECT grp, idx, total, leaf AS digest FROM d0), {_climb("n", levels, fanout)},
        tops AS (SELECT grp AS member, digest, row_number() OVER (ORDER BY grp) - 1 AS place FROM n{levels}),
        u0 AS (SELECT '' AS grp, place AS idx, count(*) OVER () AS total, digest FROM tops), {_climb("u", upper, fanout)},
        d AS (SELECT d0.*, tops.place, tops.digest AS subroot FROM d0 JOIN tops ON tops.member = d0.grp),
        p0 AS (SELECT d.doc_id, d.leaf, d.held, d.subroot, (SELECT digest FROM u{upper}) AS root, sha256({" || ".join(proof)}) AS proof_sha256, {carried} FROM d {" ".join(joins)}),
        {", ".join(folds)}
        SELECT doc_id, leaf, subroot, root, proof_sha256, held AS folded_root, held = root AS verified FROM {last}
    """


def codes(rounds: int = 4, parts: int = 4, entries: int = 256) -> str:
    """Codes of embeddings: every part against every entry, in each round."""
    steps = []
    for k in range(rounds + 1):
        steps.append(
            f"a{k} AS (SELECT row, p, arg_min(i, d * {entries} + i) AS i, min(d) AS d FROM (SELECT x.row, x.p, c.i, x.n + c.n - 2 * list_inner_product(x.e, c.e) AS d FROM x JOIN c{k} c ON c.p = x.p) GROUP BY row, p)"
        )
        if k < rounds:
            steps.append(
                f"s{k} AS (SELECT p, i, list(e ORDER BY j) AS e FROM (SELECT a.p, a.i, j, floor(sum(x.e[j]) / count(*)) AS e FROM a{k} a JOIN x ON x.row = a.row AND x.p = a.p, unnest(range(1, len(x.e) + 1)) AS t(j) GROUP BY a.p, a.i, j) GROUP BY p, i)"
            )
            steps.append(f"c{k + 1} AS (SELECT p, i, e, list_inner_product(e, e) AS n FROM (SELECT c.p, c.i, coalesce(s.e, c.e) AS e FROM c{k} c LEFT JOIN s{k} s ON s.p = c.p AND s.i = c.i))")
    return f"""
        WITH v AS (
            SELECT vec_id, label, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q, row_number() OVER (ORDER BY vec_id) AS row
            FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), x AS (
            SELECT row, p, e, list_inner_product(e, e) AS n FROM (SELECT row, p, q[p * len(q) // {parts} + 1 : (p + 1) * len(q) // {parts}] AS e FROM v, unnest(range({parts})) AS t(p))
        ), c0 AS (SELECT p, row - 1 AS i, e, n FROM x WHERE row <= {entries}), {", ".join(steps)},
        b AS (SELECT sha256(string_agg(CAST(e[j] AS BIGINT), ',' ORDER BY p, i, j)) AS codebooks_sha256 FROM c{rounds}, unnest(range(1, len(e) + 1)) AS t(j)),
        f AS (SELECT row, string_agg(printf('%02x', i), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY row)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM f JOIN v USING (row) CROSS JOIN b
    """
