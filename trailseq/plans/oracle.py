"""The registered queries in SQL, written against the given tables only."""

from __future__ import annotations

_ZEROS = "list_transform(range(64), lambda i: CAST(0 AS DOUBLE))"


def _checksum(vec: str) -> str:
    return f"round(coalesce(list_sum(list_transform({vec}, lambda x, i: x * i)), 0), 6)"


# Named parts; a query takes the ones it needs together with what they rest on.
_PARTS: dict[str, tuple[str, tuple[str, ...]]] = {
    "ev": ("""
        SELECT user_id, ts, event_id, event_type, value, k,
               k * 6 + length(event_type) - 4 AS item_id,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS rnk
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""", ()),
    "pieces": ("""
        SELECT user_id, rnk // 24 AS piece, list(item_id ORDER BY rnk) AS history,
               list_sort(list(DISTINCT event_type)) AS types,
               count(*) FILTER (WHERE event_type = 'click') AS n_click,
               count(*) FILTER (WHERE event_type = 'error') AS n_error,
               count(*) FILTER (WHERE event_type = 'purchase') AS n_purchase,
               count(*) FILTER (WHERE event_type = 'signup') AS n_signup,
               count(*) FILTER (WHERE event_type = 'view') AS n_view,
               min(k) AS min_k, max(k) AS max_k, CAST(floor(max(value)) AS BIGINT) AS top_value
        FROM ev GROUP BY user_id, rnk // 24""", ("ev",)),
    "ctx": ("""
        SELECT user_id, piece, unnest(types) AS event_type,
               array_to_string([n_click, n_error, n_purchase, n_signup, n_view, min_k, max_k, user_id,
                                CASE WHEN n_purchase > 0 THEN top_value ELSE 0 END,
                                CASE WHEN n_signup > 0 THEN 1 ELSE 0 END], ',') AS reader,
               CASE WHEN n_view > 0 THEN history END AS history
        FROM pieces""", ("pieces",)),
    "collected": ("SELECT reader, history FROM ctx WHERE len(history) >= 3", ("ctx",)),
    "vecs": (f"""
        SELECT vec_id AS item_id,
               CASE WHEN label = 9 THEN CAST([] AS DOUBLE[]) WHEN label = 8 THEN {_ZEROS}
                    ELSE CAST(embedding AS DOUBLE[]) END AS vec,
               label = 8 AS is_pad
        FROM embeddings""", ()),
    "known": ("SELECT * FROM vecs WHERE len(vec) > 0", ("vecs",)),
    "steps": ("""
        SELECT history, unnest(history) AS item_id, generate_subscripts(history, 1) AS pos
        FROM (SELECT DISTINCT history FROM collected)""", ("collected",)),
    "kept": ("""
        SELECT DISTINCT items FROM (
            SELECT list(item_id ORDER BY pos) AS items FROM steps JOIN known USING (item_id) GROUP BY history)
        WHERE len(items) >= 3""", ("steps", "known")),
    "res": ("""
        SELECT sha256(CAST(to_json(items) AS VARCHAR)) AS seq_id, len(items) AS n, CAST(pos - 1 AS INTEGER) AS pos, item_id, vec, is_pad
        FROM (SELECT items, unnest(items) AS item_id, generate_subscripts(items, 1) AS pos FROM kept)
        JOIN known USING (item_id)""", ("kept", "known")),
    "clip": ("SELECT *, pos - greatest(n - 18, 0) AS cpos FROM res WHERE pos >= n - 18", ("res",)),
    "ends": ("""
        SELECT seq_id, max(cpos) FILTER (WHERE NOT is_pad) AS last, CAST(count(*) FILTER (WHERE NOT is_pad) AS INTEGER) AS n_real
        FROM clip GROUP BY seq_id HAVING count(*) FILTER (WHERE NOT is_pad) >= 2""", ("clip",)),
    "prep": (f"""
        SELECT e.seq_id, e.n_real, p.pos, coalesce(c.vec, {_ZEROS}) AS vec, coalesce(c.is_pad, TRUE) AS is_pad
        FROM ends e CROSS JOIN (SELECT CAST(unnest(range(18)) AS INTEGER) AS pos) p
        LEFT JOIN clip c ON c.seq_id = e.seq_id AND c.cpos = p.pos - (17 - e.last)""", ("ends", "clip")),
    "realv": ("""
        SELECT seq_id, CAST(row_number() OVER (PARTITION BY seq_id ORDER BY pos) - 1 AS INTEGER) AS pos, vec
        FROM prep WHERE NOT is_pad""", ("prep",)),
    "channels": ("SELECT unnest(vec) AS x FROM realv", ("realv",)),
    "rng": ("SELECT min(x) AS lo, max(x) AS hi FROM channels", ("channels",)),
    "sums": ("SELECT seq_id, pos, list_sum(vec) AS x FROM realv", ("realv",)),
    "pred": ("""
        SELECT seq_id, pos - 1 AS pos, list(x ORDER BY c) AS vec
        FROM (SELECT seq_id, pos, c,
                     avg(x) OVER (PARTITION BY seq_id, c ORDER BY pos ROWS UNBOUNDED PRECEDING) AS x
              FROM (SELECT seq_id, pos, unnest(vec) AS x, generate_subscripts(vec, 1) AS c
                    FROM prep WHERE pos BETWEEN 1 AND 16))
        GROUP BY seq_id, pos""", ("prep",)),
    "pairs": ("""
        SELECT pred.seq_id, pred.pos, pred.vec AS prediction, prep.vec AS target
        FROM pred JOIN prep ON prep.seq_id = pred.seq_id AND prep.pos = pred.pos + 2""", ("pred", "prep")),
    "asked": ("""
        SELECT seq_id, pos, 'pred' AS which, prediction AS vec FROM pairs
        UNION ALL SELECT seq_id, pos, 'true', target FROM pairs""", ("pairs",)),
    "sims": ("""
        SELECT a.seq_id, a.pos, a.which, k.item_id,
               CASE WHEN k.is_pad OR list_dot_product(a.vec, a.vec) = 0 THEN 0
                    ELSE round(list_cosine_similarity(a.vec, k.vec), 12) END AS sim
        FROM asked a CROSS JOIN known k""", ("asked", "known")),
    "decoded": ("""
        SELECT seq_id, pos, max(item_id) FILTER (WHERE which = 'pred') AS pred_item,
               max(item_id) FILTER (WHERE which = 'true') AS true_item,
               max(sim) FILTER (WHERE which = 'pred') AS sim
        FROM (SELECT seq_id, pos, which, max(sim) AS sim, min(item_id) AS item_id
              FROM (SELECT *, max(sim) OVER (PARTITION BY seq_id, pos, which) AS top FROM sims)
              WHERE sim = top GROUP BY seq_id, pos, which)
        GROUP BY seq_id, pos""", ("sims",)),
    "numbered": ("""
        SELECT seq_id, row_number() OVER (ORDER BY seq_id) AS rn, count(*) OVER () AS n FROM ends""", ("ends",)),
    "batches": ("SELECT seq_id, (rn - 1) // 64 AS batch_no FROM numbered WHERE rn < n", ("numbered",)),
    "errs": ("""
        SELECT batch_no, pos,
               list_sum(list_transform(list_zip(prediction, target), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS sq,
               1 - list_dot_product(prediction, target)
                   / sqrt((list_dot_product(prediction, prediction) + 1e-12::DOUBLE)
                          * (list_dot_product(target, target) + 1e-12::DOUBLE)) AS cs
        FROM pairs JOIN batches USING (seq_id)""", ("pairs", "batches")),
    "losses": ("""
        SELECT batch_no,
               sqrt(head + 1e-6::DOUBLE) + 1.3::DOUBLE * sqrt(last + 1e-6::DOUBLE) AS weighted_rmse,
               sqrt(mse + 1e-6::DOUBLE) AS rmse, cosine, cosine + mse AS cosine_mse,
               head + cosine_last AS mse_last_cosine
        FROM (SELECT batch_no,
                     sum(sq) FILTER (WHERE pos < 15) / (64 * count(*) FILTER (WHERE pos < 15)) AS head,
                     sum(sq) FILTER (WHERE pos = 15) / (64 * count(*) FILTER (WHERE pos = 15)) AS last,
                     sum(sq) / (64 * count(*)) AS mse, avg(cs) AS cosine,
                     avg(cs) FILTER (WHERE pos = 15) AS cosine_last
              FROM errs GROUP BY batch_no)""", ("errs",)),
    "lengths": ("SELECT CAST(len(history) AS BIGINT) AS x FROM collected", ("collected",)),
}


def _needed(names: tuple[str, ...]) -> list[str]:
    wanted: set[str] = set()

    def visit(name: str) -> None:
        if name not in wanted:
            wanted.add(name)
            for other in _PARTS[name][1]:
                visit(other)

    for name in names:
        visit(name)
    return [name for name in _PARTS if name in wanted]


def _sql(body: str, *names: str) -> str:
    parts = ",\n".join(f"{name} AS ({_PARTS[name][0]})" for name in _needed(names))
    return f"WITH {parts}\n{body}"


def _stats(values: str, *names: str) -> str:
    return _sql(f"""
        SELECT count(*) AS n, round(avg(x), 8) AS mean_length, median(x) AS median_length
        FROM ({values})""", *names)


def _histogram(values: str, bins: int, *names: str) -> str:
    return _sql(f"""
        , r AS (SELECT CAST(min(x) AS DOUBLE) AS lo, (CAST(max(x) AS DOUBLE) - CAST(min(x) AS DOUBLE)) / {bins} AS w
                FROM {values}),
        filled AS (SELECT CAST(least(floor((x - lo) / w), {bins - 1}) AS BIGINT) AS bin, count(*) AS n
                   FROM (SELECT CAST(x AS DOUBLE) AS x FROM {values}) v CROSS JOIN r GROUP BY 1)
        SELECT bin, round(lo + bin * w, 6) AS bin_low, round(lo + (bin + 1) * w, 6) AS bin_high, coalesce(n, 0) AS n
        FROM (SELECT CAST(unnest(range({bins})) AS BIGINT) AS bin) b CROSS JOIN r LEFT JOIN filled USING (bin)""", *names)


def _generated(level: str) -> str:
    """``level`` gives the value at position ``pos`` and channel ``c`` (from 1), ``v`` = validation."""
    return f"""
        WITH shape AS (
            SELECT part, v, p.pos, c.c
            FROM (SELECT 'train' AS part, FALSE AS v UNION ALL SELECT 'validation', TRUE) s
            CROSS JOIN (SELECT CAST(unnest(range(18)) AS INTEGER) AS pos) p CROSS JOIN (SELECT unnest(range(1, 65)) AS c) c),
        sums AS (SELECT part, pos, round(sum(c * ({level})), 6) AS checksum FROM shape GROUP BY part, pos)
        SELECT c_custkey, part, pos, checksum FROM customer CROSS JOIN sums"""


_READER_AND_HISTORY = "reader, array_to_string(history, ',') AS history"
_ITEM_VECTOR = f"item_id, CAST(len(vec) AS INTEGER) AS n, {_checksum('vec')} AS checksum"
_FALLING = "(pos % 2 = CASE WHEN v THEN 0 ELSE 1 END)"

ALL: dict[str, str] = {
    "decode_accuracy": _sql("""
        SELECT count(*) AS n, CAST(sum(CASE WHEN pred_item = true_item THEN 1 ELSE 0 END) AS BIGINT) AS hits,
               round(avg(CASE WHEN pred_item = true_item THEN 1 ELSE 0 END), 8) AS accuracy
        FROM decoded""", "decoded"),
    "collect_histories": _sql(f"SELECT {_READER_AND_HISTORY} FROM collected", "collected"),
    "user_fingerprint": _sql("SELECT user_id, piece, event_type, reader AS fingerprint FROM ctx", "ctx"),
    "distinct_histories": _sql(f"SELECT DISTINCT {_READER_AND_HISTORY} FROM collected", "collected"),
    "last_history_per_user": _sql("""
        SELECT user_id, array_to_string(arg_max(history, piece), ',') AS history
        FROM pieces GROUP BY user_id""", "pieces"),
    "stream_collect": _sql(f"SELECT {_READER_AND_HISTORY} FROM collected", "collected"),
    "json_roundtrip": _sql(f"SELECT {_ITEM_VECTOR} FROM known", "known"),
    "history_files": _sql("""
        SELECT CASE WHEN piece = 0 THEN 'a' ELSE 'b' END AS directory, count(*) AS n,
               CAST(sum(len(history)) AS BIGINT) AS items
        FROM pieces GROUP BY 1""", "pieces"),
    "file_profile": _stats(
        "SELECT len(arg_max(history, piece)) AS x FROM pieces GROUP BY user_id", "pieces"),
    "latest_partition": _sql("""
        SELECT event_id, item_id, CAST(day(ts) AS VARCHAR) AS day, 'name' AS rule FROM ev
        WHERE CAST(day(ts) AS VARCHAR) = (SELECT max(CAST(day(ts) AS VARCHAR)) FROM events)
        UNION ALL
        SELECT event_id, item_id, CAST(day(ts) AS VARCHAR), 'number' FROM ev
        WHERE day(ts) = (SELECT max(day(ts)) FROM events)""", "ev"),
    "feature_decode": _sql(f"SELECT {_ITEM_VECTOR} FROM vecs", "vecs"),
    "distinct_items": _sql("SELECT DISTINCT item_id FROM steps", "steps"),
    "lookup_left": _sql(f"""
        SELECT item_id, CAST(coalesce(len(vec), 0) AS INTEGER) AS n, {_checksum('vec')} AS checksum
        FROM (SELECT DISTINCT item_id FROM steps) LEFT JOIN vecs USING (item_id)""", "steps", "vecs"),
    "lookup_table": _sql(f"""
        SELECT {_ITEM_VECTOR} FROM known WHERE item_id IN (SELECT item_id FROM steps)""", "known", "steps"),
    "resolve_histories": _sql(f"""
        SELECT seq_id, pos, item_id, {_checksum('vec')} AS checksum FROM res""", "res"),
    "resolve_histories_padded": _sql(f"""
        , kept2 AS (SELECT DISTINCT items FROM (
            SELECT list(item_id ORDER BY pos) AS items FROM steps
            WHERE item_id NOT IN (SELECT item_id FROM vecs WHERE len(vec) = 0) GROUP BY history)
            WHERE len(items) >= 3)
        SELECT sha256(CAST(to_json(items) AS VARCHAR)) AS seq_id, CAST(pos - 1 AS INTEGER) AS pos, item_id,
               {_checksum('vec')} AS checksum
        FROM (SELECT items, unnest(items) AS item_id, generate_subscripts(items, 1) AS pos FROM kept2)
        LEFT JOIN vecs USING (item_id)""", "steps", "vecs"),
    "prepare_sequences": _sql(f"""
        SELECT seq_id, n_real, pos, {_checksum('vec')} AS checksum FROM prep""", "prep"),
    "trainable_roundtrip": _sql(f"""
        SELECT pos, {_checksum('vec')} AS checksum, count(*) AS n FROM prep GROUP BY 1, 2""", "prep"),
    "padding_mask": _sql("""
        SELECT seq_id, string_agg(b, '' ORDER BY pos) AS mask,
               string_agg(b, '' ORDER BY pos) FILTER (WHERE pos BETWEEN 1 AND 16) AS source_mask
        FROM (SELECT seq_id, pos, CASE WHEN is_pad THEN '1' ELSE '0' END AS b FROM prep)
        GROUP BY seq_id""", "prep"),
    "sequence_long": _sql(f"SELECT seq_id, pos, {_checksum('vec')} AS checksum FROM prep", "prep"),
    "shifted_windows": _sql(f"""
        SELECT e.seq_id, e.pos, {_checksum('e.vec')} AS encoder, {_checksum('s.vec')} AS source,
               {_checksum('t.vec')} AS target
        FROM prep e JOIN prep s ON s.seq_id = e.seq_id AND s.pos = e.pos + 1
        JOIN prep t ON t.seq_id = e.seq_id AND t.pos = e.pos + 2""", "prep"),
    "short_windows": _sql(f"""
        SELECT s.seq_id, s.pos - 13 AS pos, {_checksum('s.vec')} AS source, {_checksum('t.vec')} AS target
        FROM prep s JOIN prep t ON t.seq_id = s.seq_id AND t.pos = s.pos + 1
        WHERE s.pos BETWEEN 13 AND 16""", "prep"),
    "shifted_long": _sql(f"""
        SELECT a.seq_id, a.pos, {_checksum('a.vec')} AS checksum, {_checksum('b.vec')} AS next_checksum
        FROM prep a JOIN prep b ON b.seq_id = a.seq_id AND b.pos = a.pos + 1""", "prep"),
    "hash_split": _sql("""
        SELECT seq_id, n_real,
               CASE WHEN left(md5(seq_id), 4) < 'e666' THEN 'train' ELSE 'validation' END AS split
        FROM ends""", "ends"),
    "prefix_split": _sql("""
        SELECT seq_id, CASE WHEN rn <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split
        FROM numbered""", "numbered"),
    "split_sizes": _sql("""
        SELECT split, count(*) AS samples, count(*) // 64 AS batches
        FROM (SELECT CASE WHEN rn <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM numbered)
        GROUP BY split""", "numbered"),
    "batch_numbers": _sql("SELECT seq_id, batch_no FROM batches", "batches"),
    "history_length_stats": _stats("SELECT x FROM lengths", "lengths"),
    "unique_history_ratio": _sql("""
        SELECT n_unique, n_all, round(n_unique::DOUBLE / n_all, 8) AS ratio
        FROM (SELECT count(*) AS n_all, count(DISTINCT history) AS n_unique FROM collected)""", "collected"),
    "unique_history_stats": _stats(
        "SELECT len(history) AS x FROM (SELECT DISTINCT history FROM collected)", "collected"),
    "unpadded_lengths": _stats("SELECT count(*) AS x FROM realv GROUP BY seq_id", "realv"),
    "channel_range": _sql("""
        SELECT lo AS min_channel, hi AS max_channel FROM rng""", "rng"),
    "vector_sums": _sql("SELECT seq_id, pos, round(x, 6) AS channel_sum FROM sums", "sums"),
    "normalized_sums": _sql("""
        SELECT seq_id, pos, round(list_sum(list_transform(vec, lambda x: (x - lo) / (hi - lo))), 6) AS channel_sum
        FROM realv CROSS JOIN rng""", "realv", "rng"),
    "length_histogram": _histogram("lengths", 10, "lengths"),
    "length_histogram_auto": _sql("""
        , s AS (SELECT CAST(min(x) AS DOUBLE) AS lo, CAST(max(x) AS DOUBLE) AS hi, CAST(count(*) AS DOUBLE) AS n,
                       quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr FROM lengths),
        b AS (SELECT lo, hi, CAST(ceil((hi - lo) / CASE WHEN iqr > 0
                  THEN least(2 * iqr / pow(n, 1.0::DOUBLE / 3), (hi - lo) / (log2(n) + 1))
                  ELSE (hi - lo) / (log2(n) + 1) END) AS BIGINT) AS bins FROM s)
        SELECT bin, round(lo + bin * w, 6) AS bin_low, round(lo + (bin + 1) * w, 6) AS bin_high, coalesce(n, 0) AS n
        FROM (SELECT lo, (hi - lo) / bins AS w, unnest(range(bins)) AS bin FROM b)
        LEFT JOIN (SELECT CAST(least(floor((x - lo) / ((hi - lo) / bins)), bins - 1) AS BIGINT) AS bin, count(*) AS n
                   FROM lengths CROSS JOIN b GROUP BY 1) USING (bin)""", "lengths"),
    "sum_histogram_auto": _sql("""
        , s AS (SELECT CAST(min(x) AS DOUBLE) AS lo, CAST(max(x) AS DOUBLE) AS hi, CAST(count(*) AS DOUBLE) AS n,
                       quantile_cont(CAST(x AS DOUBLE), 0.75) - quantile_cont(CAST(x AS DOUBLE), 0.25) AS iqr FROM sums),
        b AS (SELECT lo, hi, CAST(ceil((hi - lo) / CASE WHEN iqr > 0
                  THEN least(2 * iqr / pow(n, 1.0::DOUBLE / 3), (hi - lo) / (log2(n) + 1))
                  ELSE (hi - lo) / (log2(n) + 1) END) AS BIGINT) AS bins FROM s)
        SELECT bin, round(lo + bin * w, 6) AS bin_low, round(lo + (bin + 1) * w, 6) AS bin_high, coalesce(n, 0) AS n
        FROM (SELECT lo, (hi - lo) / bins AS w, unnest(range(bins)) AS bin FROM b)
        LEFT JOIN (SELECT CAST(least(floor((x - lo) / ((hi - lo) / bins)), bins - 1) AS BIGINT) AS bin, count(*) AS n
                   FROM sums CROSS JOIN b GROUP BY 1) USING (bin)""", "sums"),
    "unique_length_histogram": _histogram(
        "(SELECT len(history) AS x FROM (SELECT DISTINCT history FROM collected))", 10, "collected"),
    "unpadded_histogram": _histogram("(SELECT count(*) AS x FROM realv GROUP BY seq_id)", 10, "realv"),
    "channel_histogram": _histogram("channels", 20, "channels"),
    "normalized_histogram": _histogram(
        "(SELECT (x - lo) / (hi - lo) AS x FROM channels CROSS JOIN rng)", 20, "channels", "rng"),
    "sum_histogram": _histogram("sums", 20, "sums"),
    "length_kde": _sql("""
        , s AS (SELECT min(x) AS lo, max(x) AS hi, CAST(count(*) AS DOUBLE) AS n,
                       stddev_samp(x) * pow(count(*), -0.2::DOUBLE) AS h FROM lengths),
        c AS (SELECT x, count(*) AS w FROM lengths GROUP BY x)
        SELECT CAST(g AS INTEGER) AS grid_no, round(gx, 6) AS x,
               round(sum(w * exp(-0.5::DOUBLE * pow((gx - c.x) / h, 2))) / (n * h * sqrt(2 * pi())), 8) AS density
        FROM c CROSS JOIN (SELECT g, lo + g * ((hi - lo) / 199::DOUBLE) AS gx, n, h
                           FROM s CROSS JOIN (SELECT unnest(range(200)) AS g)) q
        GROUP BY g, gx, n, h""", "lengths"),
    "channel_kde": _sql("""
        , b AS (SELECT x_lo + (bin + 0.5::DOUBLE) * w AS x, n FROM (
            SELECT lo AS x_lo, (hi - lo) / 100 AS w,
                   CAST(least(floor((x - lo) / ((hi - lo) / 100)), 99) AS BIGINT) AS bin, count(*) AS n
            FROM channels CROSS JOIN rng GROUP BY 1, 2, 3)),
        m AS (SELECT min(x) AS lo, max(x) AS hi, CAST(sum(n) AS DOUBLE) AS n, sum(x * n) / sum(n) AS mean FROM b),
        s AS (SELECT lo, hi, n, sqrt((SELECT sum(b.n * pow(b.x - m.mean, 2)) FROM b CROSS JOIN m) / (n - 1))
                     * pow(n, -0.2::DOUBLE) AS h FROM m)
        SELECT CAST(g AS INTEGER) AS grid_no, round(gx, 6) AS x,
               round(sum(b.n * exp(-0.5::DOUBLE * pow((gx - b.x) / h, 2))) / (q.n * h * sqrt(2 * pi())), 6) AS density
        FROM b CROSS JOIN (SELECT g, lo + g * ((hi - lo) / 199::DOUBLE) AS gx, n, h
                           FROM s CROSS JOIN (SELECT unnest(range(200)) AS g)) q
        GROUP BY g, gx, q.n, h""", "channels", "rng"),
    "l2_normalize": _sql(f"""
        SELECT seq_id, pos, {_checksum('list_transform(vec, lambda y: y / norm)')} AS checksum
        FROM (SELECT *, greatest(sqrt(list_dot_product(vec, vec)), 1e-12::DOUBLE) AS norm FROM pred)""", "pred"),
    "hard_shrink": _sql(f"""
        SELECT item_id, CAST(len(list_filter(s, lambda x: x = 0)) AS INTEGER) AS zeros,
               {_checksum('s')} AS checksum
        FROM (SELECT item_id, list_transform(vec, lambda x: CASE WHEN abs(x) > 0.01::DOUBLE THEN x
                                                          ELSE 0::DOUBLE END) AS s FROM known)""", "known"),
    "positional_features": _sql("""
        , chan AS (SELECT seq_id, pos, unnest(vec) AS x, generate_subscripts(vec, 1) - 1 AS c FROM prep),
        enc AS (SELECT seq_id, pos, c, x + CASE WHEN c % 2 = 0
                       THEN sin(pos * exp(-(c - c % 2) * ln(10000::DOUBLE) / 64))
                       ELSE cos(pos * exp(-(c - c % 2) * ln(10000::DOUBLE) / 64)) END AS x FROM chan)
        SELECT seq_id, pos, round(sum(x * (c + 1)), 6) AS checksum FROM enc GROUP BY seq_id, pos""", "prep"),
    "first_channels": _sql("""
        SELECT seq_id, pos - 2 AS pos, round(vec[1], 6) AS channel_1, round(vec[2], 6) AS channel_2,
               round(vec[3], 6) AS channel_3
        FROM prep WHERE pos >= 2""", "prep"),
    "mean_prediction": _sql(f"SELECT seq_id, pos, {_checksum('vec')} AS checksum FROM pred", "pred"),
    "score_sequences": _sql(f"""
        SELECT seq_id, pos, {_checksum('prediction')} AS checksum, {_checksum('target')} AS target
        FROM pairs""", "pairs"),
    "score_encoder_decoder": _sql("""
        , chan AS (SELECT seq_id, pos, is_pad, unnest(vec) AS x, generate_subscripts(vec, 1) AS c FROM prep),
        enc AS (SELECT seq_id, c, avg(x) AS x FROM chan WHERE pos < 16 GROUP BY seq_id, c)
        SELECT s.seq_id, s.pos - 1 AS pos, round(sum(s.c * CASE WHEN s.is_pad THEN enc.x ELSE s.x END), 6) AS checksum
        FROM chan s JOIN enc ON enc.seq_id = s.seq_id AND enc.c = s.c
        WHERE s.pos BETWEEN 1 AND 16 GROUP BY s.seq_id, s.pos""", "prep"),
    "short_sequence_loss": _sql("""
        , chan AS (SELECT seq_id, pos, unnest(vec) AS x, generate_subscripts(vec, 1) AS c FROM prep WHERE pos >= 13),
        short AS (SELECT seq_id, pos, c, avg(x) OVER (PARTITION BY seq_id, c ORDER BY pos ROWS UNBOUNDED PRECEDING) AS x
                  FROM chan WHERE pos <= 16),
        err AS (SELECT s.seq_id, s.pos, sum((s.x - t.x) * (s.x - t.x)) AS sq
                FROM short s JOIN chan t ON t.seq_id = s.seq_id AND t.c = s.c AND t.pos = s.pos + 1 GROUP BY 1, 2)
        SELECT batch_no, round(sqrt(sum(sq) FILTER (WHERE pos < 16) / (64 * count(*) FILTER (WHERE pos < 16)) + 1e-6::DOUBLE)
               + 1.3::DOUBLE * sqrt(sum(sq) FILTER (WHERE pos = 16) / (64 * count(*) FILTER (WHERE pos = 16)) + 1e-6::DOUBLE), 8)
               AS weighted_rmse
        FROM err JOIN batches USING (seq_id) GROUP BY batch_no""", "prep", "batches"),
    "sequence_loss": _sql("""
        SELECT count(*) AS batches, round(avg(weighted_rmse), 8) AS loss,
               round(exp(avg(weighted_rmse)), 8) AS perplexity FROM losses""", "losses"),
    "sequence_loss_variants": _sql("""
        SELECT batch_no, round(weighted_rmse, 8) AS weighted_rmse, round(rmse, 8) AS rmse,
               round(cosine, 8) AS cosine, round(cosine_mse, 8) AS cosine_mse,
               round(mse_last_cosine, 8) AS mse_last_cosine FROM losses""", "losses"),
    "nearest_item": _sql("""
        SELECT seq_id, pos, pred_item, true_item, round(sim, 8) AS similarity FROM decoded""", "decoded"),
    "exact_item": _sql("""
        SELECT prep.seq_id, prep.pos - 2 AS pos, k.item_id, k.item_id IS NOT NULL AS found
        FROM prep LEFT JOIN (SELECT vec, min(item_id) AS item_id FROM known GROUP BY vec) k ON k.vec = prep.vec
        WHERE prep.pos >= 2""", "prep", "known"),
    "gen_alternating": _generated(
        f"CASE WHEN {_FALLING} THEN 18 - pos ELSE pos END / 18::DOUBLE"),
    "gen_uninteresting": _generated(
        f"CASE WHEN {_FALLING} THEN 0.5::DOUBLE ELSE pos / 18::DOUBLE END"),
    "gen_embedding": _generated(f"""
        CASE WHEN {_FALLING}
             THEN (18 - pos) / CASE WHEN c % CASE WHEN v THEN 4 ELSE 3 END = 0 THEN 3::DOUBLE ELSE 18::DOUBLE END
             ELSE pos / CASE WHEN v THEN 1::DOUBLE ELSE 18::DOUBLE END END"""),
    "gen_noise": """
        SELECT pos, count(*) * 64 AS n, TRUE AS centred, TRUE AS unit_spread, TRUE AS repeats
        FROM customer CROSS JOIN (SELECT CAST(unnest(range(18)) AS INTEGER) AS pos) p GROUP BY pos""",
    "random_users": """
        SELECT c_nationkey, count(*) AS n, count(*) AS users, 5 * count(*) AS n_values, 5 * count(*) AS values
        FROM customer GROUP BY c_nationkey""",
}
