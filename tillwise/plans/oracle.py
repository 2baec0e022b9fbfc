"""DuckDB counterparts of the registered queries.

Each statement is written from the rules, not from the Spark plan: where the Spark
side uses summaries, ranges or incremental state, the statement takes the direct
way over whole tables.
"""

from __future__ import annotations

from tillwise.functions.lexicon import default_entries
from tillwise.functions.text import INTENSIFIERS, NEGATION_FACTOR, NEGATIONS, POLARITY
from tillwise.operators.baskets import CONFIDENCE, SUPPORT_FULL
from tillwise.operators.cleaning import CORRUPT_MARK, EMPTY_REVIEW_TEXT
from tillwise.plans.queries import BATCH_SIZE, RULE_CONFIDENCE, SPLITS, THRESHOLDS
from tillwise.sources.feeds import REVIEW_PHRASES


def _map(entries: dict[str, float]) -> str:
    keys = ", ".join(f"'{k}'" for k in entries)
    values = ", ".join(f"cast({v} as double)" for v in entries.values())
    return f"map([{keys}], [{values}])"


_LEXICON = ", ".join(
    f"('{p}', '{role}', cast({v} as double), {scope})"
    for p, role, v, scope, *_ in default_entries() if len(p.split()) < 3
)
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"
_PHRASES = ", ".join(f"({i}, '{p}')" for i, p in enumerate(REVIEW_PHRASES))


def _r(expr: str, digits: int = 4) -> str:
    return f"round(cast({expr} as double), {digits}) + cast(0 as double)"


# name -> (needed parts, body)
_PARTS: dict[str, tuple[list[str], str]] = {
    "tx": (
        [],
        """
        select event_id as txn_id, user_id,
               case when event_id % 500 = 3 then cast(0 as double)
                    when event_id % 100 = 7 then -value * 4 else value * 4 end as amount,
               case when event_id % 50 = 11 then null
                    when k % 8 = 0 then cast(k as bigint) + 100 else user_id % 20 end as location_id,
               user_id * 10 + k % 6 as device_id, ts as timestamp,
               cast(case when (k % 8 = 0 and value > 60) or (value > 120 and event_id % 3 = 0)
                    or event_id % 41 = 0 then 1 else 0 end as integer) as is_fraud
        from (select event_id, user_id, value, ts,
                     cast(json_extract_string(props, '$.k') as int) as k from events) e""",
    ),
    "modes": (
        ["tx"],
        """
        select user_id, location_id as home from (
            select user_id, location_id,
                   row_number() over (partition by user_id order by count(*) desc, location_id) as rn
            from tx where location_id is not null group by user_id, location_id) c
        where rn = 1""",
    ),
    "txc": (
        ["tx", "modes"],
        """
        select t.txn_id, t.user_id,
               case when abs(t.amount) <= 0
                    then (select quantile_cont(abs(amount), 0.5) from tx)
                    else abs(t.amount) end as amount,
               coalesce(t.location_id, m.home,
                        (select cast(trunc(quantile_cont(location_id, 0.5)) as bigint) from tx)) as location_id,
               t.device_id, t.timestamp, t.is_fraud
        from tx t left join modes m on t.user_id = m.user_id""",
    ),
    "homes": (
        ["txc"],
        """
        select user_id, location_id as home from (
            select user_id, location_id,
                   row_number() over (partition by user_id order by count(*) desc, location_id) as rn
            from txc where location_id is not null group by user_id, location_id) c
        where rn = 1""",
    ),
    "feat": (
        ["txc", "homes"],
        """
        select t.*,
               coalesce(cast(t.location_id <> h.home as integer), 1) as unusual_location,
               cast(round(t.amount, 6) > round(p.p95, 6) as integer) as high_spend,
               cast(row_number() over (partition by t.user_id, t.device_id
                                       order by t.timestamp, t.txn_id) = 1 as integer) as new_device
        from txc t
        left join homes h on t.user_id = h.user_id
        join (select user_id, quantile_cont(amount, 0.95) as p95 from txc group by user_id) p
          on t.user_id = p.user_id""",
    ),
    "scored": (
        ["feat"],
        "select *, round(amount / (amount + 500.0), 6) as score from feat",
    ),
    "flagged": (
        ["scored"],
        """
        select *, score > (select quantile_cont(score, 0.97) from scored) as outlier from scored""",
    ),
    "alarm": (
        ["txc"],
        """
        select cast(is_fraud as varchar) as label,
               cast(cast(amount > 500 as integer) as varchar) as prediction from txc""",
    ),
    "reviews": (
        [],
        f"""
        select d.doc_id as review_id, d.doc_id % 97 as user_id, d.doc_id % 50 as product_id,
               case when d.doc_id % 67 = 5 then null
                    when d.doc_id % 50 = 9 then concat(p.phrase, ' ###CORRUPT###')
                    when d.doc_id % 71 = 2 then ' ###CORRUPT### '
                    else d.text || ' ' || p.phrase end as text,
               case when l.toxic = 1 then 'negative' when l.quality = 1 then 'positive'
                    when l.quality = 0 then 'neutral' else null end as true_sentiment
        from documents d left join labels l on d.doc_id = l.doc_id
        join (values {_PHRASES}) p(n, phrase) on d.doc_id % 5 = p.n""",
    ),
    "reviews_stripped": (
        ["reviews"],
        f"""
        select review_id, user_id, product_id, true_sentiment,
               regexp_replace(regexp_replace(replace(coalesce(text, ''), '{CORRUPT_MARK}', ''),
                              '^{_SPACE}', ''), '{_SPACE}$', '') as stripped
        from reviews""",
    ),
    "reviews_clean": (
        ["reviews_stripped"],
        f"""
        select review_id, user_id, product_id,
               case when stripped = '' then '{EMPTY_REVIEW_TEXT}' else stripped end as text,
               true_sentiment
        from reviews_stripped""",
    ),
    "words": (
        ["reviews_clean"],
        """
        select review_id, u.token as token, u.pos as pos
        from (select review_id, regexp_extract_all(lower(text), '[a-z'']+') as tokens
              from reviews_clean) r,
             unnest(tokens) with ordinality as u(token, pos)""",
    ),
    "strengths": (
        ["words"],
        f"""
        select review_id, pos,
               greatest(-1.0, least(1.0,
                   {_map(POLARITY)}[token]
                   * coalesce({_map(INTENSIFIERS)}[before], 1.0)
                   * case when coalesce(case when {_map(INTENSIFIERS)}[before] is null then before
                                        else before2 end, '') in ({", ".join(f"'{n}'" for n in NEGATIONS)})
                          then {NEGATION_FACTOR} else 1.0 end)) as strength
        from (select *, lag(token) over w as before, lag(token, 2) over w as before2
              from words window w as (partition by review_id order by pos)) x
        where token in ({", ".join(f"'{w}'" for w in POLARITY)})""",
    ),
    # No phrase ends with the word another begins with, so a pair of words that is a phrase
    # is always taken, and the second word never begins a match.
    "matches": (
        ["reviews_clean"],
        rf"""
        select review_id, pos, len, role, value, scope,
               coalesce(sum(case when role = 'score' then 1 else 0 end) over (
                   partition by review_id order by pos
                   rows between unbounded preceding and 1 preceding), 0) as part
        from (select review_id, pos, token, pair,
                     lag(pair in (select phrase from (values {_LEXICON}) l(phrase, role, value, scope)))
                         over (partition by review_id order by pos) as taken
              from (select review_id, u.pos as pos, u.token as token,
                           u.token || ' ' || lead(u.token) over (partition by review_id order by u.pos) as pair
                    from (select review_id,
                                 regexp_extract_all(lower(text), '\p{{L}}[\p{{L}}\p{{M}}''’]*') as tokens
                          from reviews_clean) r,
                         unnest(tokens) with ordinality as u(token, pos)) w) t
        join (select *, len(string_split(phrase, ' ')) as len
              from (values {_LEXICON}) l(phrase, role, value, scope)) l
          on (l.len = 2 and l.phrase = t.pair)
             or (l.len = 1 and l.phrase = t.token
                 and coalesce(t.pair not in (select phrase from (values {_LEXICON}) k(phrase, role, value, scope)), true))
        where not coalesce(taken, false)""",
    ),
    "scaled": (
        ["matches"],
        """
        select review_id, part, max(pos) filter (where role = 'score') as pos,
               greatest(-1.0, least(1.0,
                   max(value) filter (where role = 'score')
                   * case when max(pos) filter (where role = 'score')
                               <= arg_max(pos + len - 1 + scope, pos) filter (where role = 'negation')
                          then arg_max(value, pos) filter (where role = 'negation') else 1.0 end
                   * case when max(pos) filter (where role = 'score')
                               <= arg_max(pos + len - 1 + scope, pos) filter (where role = 'intensifier')
                          then arg_max(value, pos) filter (where role = 'intensifier') else 1.0 end)) as value
        from matches group by review_id, part
        having count(*) filter (where role = 'score') > 0""",
    ),
    "sentiments": (
        ["reviews_clean", "strengths"],
        f"""
        select review_id, true_sentiment, polarity,
               case when polarity > 0.05 then 'positive' when polarity < -0.05 then 'negative'
                    else 'neutral' end as sentiment
        from (select r.review_id, r.true_sentiment,
                     {_r("coalesce(s.mean_strength, 0)")} as polarity
              from reviews_clean r left join (
                  select review_id, sum(strength order by pos) / count(*) as mean_strength
                  from strengths group by review_id) s
                on r.review_id = s.review_id) x""",
    ),
    "lines": (
        [],
        """
        select l_orderkey as order_id,
               case when (l_orderkey + l_linenumber) % 200 = 0 then null
                    when (l_orderkey + l_linenumber) % 97 = 0
                      then concat('  ', lower(p_type), '-', cast(p_size % 2 as varchar), ' ')
                    when (l_orderkey + l_linenumber) % 193 = 0 then '   '
                    else concat(p_type, '-', cast(p_size % 2 as varchar)) end as product_id
        from lineitem join part on l_partkey = p_partkey""",
    ),
    "lines_clean": (
        ["lines"],
        """
        select order_id, trim(upper(product_id)) as product_id from lines
        where product_id is not null and length(trim(product_id)) > 0""",
    ),
    "baskets": (
        ["lines_clean"],
        """
        select order_id, list_sort(list(distinct product_id)) as items
        from lines_clean group by order_id""",
    ),
    "total": (["baskets"], "select cast(count(*) as double) as n from baskets"),
    # Every subset of every basket, counted.
    "sets": (
        ["baskets", "total"],
        f"""
        select items, count(*) as freq from (
            select list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 1) as items
            from (select items, unnest(range(1, cast(pow(2, len(items)) as bigint))) as mask
                  from baskets) m) s
        group by items
        having count(*) / (select n from total) >= {SUPPORT_FULL}""",
    ),
    "rules": (
        ["sets", "total"],
        """
        select antecedents, consequents, freq / n as support, freq / a.n_ante as confidence,
               (freq / a.n_ante) / (c.n_cons / n) as lift,
               freq / n - (a.n_ante / n) * (c.n_cons / n) as leverage,
               case when freq / a.n_ante < 1 then (1 - c.n_cons / n) / (1 - freq / a.n_ante)
                    else cast('inf' as double) end as conviction
        from (select freq, n,
                     list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 1) as antecedents,
                     list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 0) as consequents
              from (select items, freq, unnest(range(1, cast(pow(2, len(items)) as bigint) - 1)) as mask
                    from sets where len(items) > 1) m, total) s
        join (select items, cast(freq as double) as n_ante from sets) a on s.antecedents = a.items
        join (select items, cast(freq as double) as n_cons from sets) c on s.consequents = c.items""",
    ),
    "churn": (
        [],
        """
        select c_custkey as user_id,
               cast(coalesce((2001*12+8) - min(year(o_orderdate)*12 + month(o_orderdate)), 0) as int) as tenure_months,
               case when c_custkey % 33 = 0 then null else max(o_totalprice) / 1000 end as monthly_spend,
               count(o_orderkey) as sessions_per_month,
               cast(coalesce(sum(case when o_orderpriority = '1-URGENT' then 1 else 0 end), 0) as bigint) as support_tickets,
               cast(case when max(o_orderdate) >= timestamp '2001-02-01 00:00:00' then 0 else 1 end as integer) as churned
        from customer left join orders on o_custkey = c_custkey group by c_custkey""",
    ),
    "ratings": (
        [],
        """
        select o_custkey as user_id, l_partkey as product_id,
               case when (l_orderkey + l_linenumber) % 50 = 0 then null else l_quantity / 8.0 end as rating
        from lineitem join orders on l_orderkey = o_orderkey""",
    ),
    "ratings_clean": (
        ["ratings"],
        """
        select user_id, product_id, cast(trunc(least(greatest(rating, 1), 5)) as integer) as rating
        from ratings where rating is not null""",
    ),
    "centred": (
        ["ratings_clean"],
        """
        select user_id, product_id, rating, rating - avg(rating) over (partition by user_id) as centred
        from (select user_id, product_id, avg(rating) as rating
              from ratings_clean group by user_id, product_id) m""",
    ),
    "signal": (["centred"], "select * from centred where abs(centred) > 1e-12"),
    "norms": (
        ["signal"],
        "select user_id, sqrt(sum(centred * centred)) as norm from signal group by user_id",
    ),
    "sims": (
        ["signal", "norms"],
        """
        select p.u, p.v, p.dot / (a.norm * b.norm) as sim from (
            select x.user_id as u, y.user_id as v, sum(x.centred * y.centred) as dot
            from signal x join signal y on x.product_id = y.product_id and x.user_id <> y.user_id
            group by x.user_id, y.user_id) p
        join norms a on p.u = a.user_id join norms b on p.v = b.user_id""",
    ),
    "near": (
        ["sims"],
        """
        select * from (
            select u as user_id, v as neighbor_id, sim,
                   row_number() over (partition by u order by round(sim, 9) desc, v) as rank
            from sims where round(sim, 9) > 0) x
        where rank <= 40""",
    ),
    "scores": (
        ["near", "signal", "centred"],
        """
        select u.user_id, p.product_id, coalesce(s.score, 0) as score
        from (select distinct user_id from centred) u
        cross join (select distinct product_id from centred) p
        left join (select n.user_id, r.product_id, sum(n.sim * r.centred) as score
                   from near n join signal r on n.neighbor_id = r.user_id
                   group by n.user_id, r.product_id) s
          on s.user_id = u.user_id and s.product_id = p.product_id
        where not exists (select 1 from signal o
                          where o.user_id = u.user_id and o.product_id = p.product_id)""",
    ),
    "recs": (
        ["scores"],
        """
        select * from (
            select user_id, product_id, score,
                   row_number() over (partition by user_id
                                      order by round(score, 9) + 0.0 desc, product_id) as rank
            from scores) x
        where rank <= 8""",
    ),
    "splits": (
        ["tx"],
        f"""
        select *, cast(case when pos < (n % {SPLITS}) * (n // {SPLITS} + 1) then pos // (n // {SPLITS} + 1)
                       else (n % {SPLITS}) + (pos - (n % {SPLITS}) * (n // {SPLITS} + 1)) // (n // {SPLITS})
                       end as integer) as split_id
        from (select *, row_number() over (order by txn_id) - 1 as pos, count(*) over () as n from tx) t""",
    ),
    "scenarios": (
        [],
        """
        select o_orderkey as scenario_id, o_custkey % 200 as user_id, o_totalprice / 500 as amount,
               case when o_orderkey % 3 = 0 then (o_custkey % 200) % 20 else o_orderkey % 25 end as location_id,
               (o_custkey % 200) * 10 + o_orderkey % 9 as device_id
        from orders""",
    ),
    # The direct reading: every scenario gets its own copy of the user's history.
    "copies": (
        ["tx", "scenarios"],
        """
        select s.scenario_id, t.user_id, abs(t.amount) as amount, t.location_id, t.device_id,
               t.timestamp, 0 as added
        from scenarios s join tx t on s.user_id = t.user_id
        union all
        select s.scenario_id, s.user_id, abs(s.amount), s.location_id, s.device_id,
               h.last_time + interval 1 minute, 1
        from scenarios s
        join (select user_id, max(timestamp) as last_time from tx group by user_id) h
          on s.user_id = h.user_id""",
    ),
    "copy_modes": (
        ["copies"],
        """
        select scenario_id, location_id as home from (
            select scenario_id, location_id,
                   row_number() over (partition by scenario_id
                                      order by count(*) desc, location_id) as rn
            from copies where location_id is not null group by scenario_id, location_id) c
        where rn = 1""",
    ),
    "copies_clean": (
        ["copies", "copy_modes"],
        """
        select c.scenario_id, c.user_id, c.device_id, c.timestamp, c.added,
               case when c.amount <= 0 then m.median else c.amount end as amount,
               coalesce(c.location_id, h.home) as location_id, h.home
        from copies c
        join (select scenario_id, quantile_cont(amount, 0.5) as median
              from copies group by scenario_id) m on c.scenario_id = m.scenario_id
        join copy_modes h on c.scenario_id = h.scenario_id""",
    ),
}


def _with(needed: list[str], select: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        if name in order:
            return
        for other in _PARTS[name][0]:
            add(other)
        order.append(name)

    for name in needed:
        add(name)
    if not order:
        return select
    parts = ",\n".join(f"{name} as ({_PARTS[name][1]})" for name in order)
    # A select may open with further parts of its own, after a leading comma.
    return f"with {parts} {select.strip()}"


_ROLLUP = f"""
    count(*) as txn_count, {{total}} as total_amount,
    cast(count(*) filter (where location_id is null) as bigint) as rows_missing_location,
    cast(count(*) filter (where amount > 500) as bigint) as high_amount_txns"""


def _rollup(table: str) -> str:
    body = _ROLLUP.format(total="round(sum(amount), 2)")
    return _with([table], f"select user_id, {body} from {table} group by user_id")


def _histogram(table: str, needed: list[str], value: str, series: str, bins: int) -> str:
    return _with(
        needed,
        f"""
        select {series} as series,
               cast(case when high > low
                    then least(floor((x - low) / (high - low) * {float(bins)}), {bins - 1})
                    else 0 end as integer) as bin,
               count(*) as n
        from (select *, {value} as x, min({value}) over () as low, max({value}) over () as high
              from {table}) t
        where x is not null group by 1, 2""",
    )


_YES_NO = "case when {} = 1 then 'Yes' when {} = 0 then 'No' end"


def _report(needed: list[str], source: str) -> str:
    """Per-class lines and averages over (label, prediction) rows."""
    return _with(
        needed,
        f"""
        , pairs as ({source}),
        classes as (
            select class, cast(sum(support) as bigint) as support, sum(predicted) as predicted,
                   sum(correct) as correct
            from (select label as class, 1 as support, 0 as predicted,
                         cast(label = prediction as integer) as correct from pairs
                  union all select prediction, 0, 1, 0 from pairs) r
            group by class),
        pr as (
            select *, case when predicted > 0 then correct / predicted else 0 end as p,
                   case when support > 0 then correct / support else 0 end as r from classes),
        prf as (
            select *, case when p + r > 0 then 2 * p * r / (p + r) else 0 end as f from pr)
        select class, {_r("p")} as precision, {_r("r")} as recall, {_r("f")} as f1_score, support
        from prf
        union all
        select 'accuracy', {_r("sum(correct) / sum(support)")}, {_r("sum(correct) / sum(support)")},
               {_r("sum(correct) / sum(support)")}, cast(sum(support) as bigint) from prf
        union all
        select 'macro avg', {_r("avg(p)")}, {_r("avg(r)")}, {_r("avg(f)")},
               cast(sum(support) as bigint) from prf
        union all
        select 'weighted avg', {_r("sum(p * support) / sum(support)")},
               {_r("sum(r * support) / sum(support)")}, {_r("sum(f * support) / sum(support)")},
               cast(sum(support) as bigint) from prf""",
    )


def statements() -> dict[str, str]:
    items = "array_to_string(items, '|') as items"
    sides = (
        "array_to_string(antecedents, '|') as antecedents, "
        "array_to_string(consequents, '|') as consequents"
    )
    thresholds = ", ".join(f"(cast({t} as double))" for t in THRESHOLDS)
    return {
        "user_spend_top20": _with(
            ["tx"],
            f"""
            select user_id, txn_count, {_r("total")} as total_amount, {_r("top")} as max_amount
            from (select user_id, count(*) as txn_count, sum(amount) as total, max(amount) as top
                  from tx group by user_id order by total desc, user_id limit 20) t""",
        ),
        "user_spend_two_phase": _with(
            ["tx"],
            f"""
            select user_id, count(*) as txn_count, {_r("sum(amount)")} as total_amount,
                   {_r("max(amount)")} as max_amount
            from tx group by user_id""",
        ),
        "fraud_user_rollup_raw": _rollup("tx"),
        "fraud_user_rollup_clean": _rollup("txc"),
        "fraud_partial_rollup": _with(
            ["splits"],
            f"""
            select split_id, user_id, {_ROLLUP.format(total=_r("sum(amount)"))}
            from splits group by split_id, user_id""",
        ),
        "fraud_merge_partials": _rollup("tx"),
        "map_reduce_rollup": _rollup("tx"),
        "array_split_sizes": _with(
            ["splits"], "select split_id, count(*) as n from splits group by split_id"
        ),
        "positional_batch_stats": _with(
            ["txc"],
            f"""
            , placed as (
                select *, row_number() over (order by txn_id) - 1 as pos from txc),
            batched as (select *, pos // {BATCH_SIZE} as batch_no from placed),
            bhomes as (
                select batch_no, user_id, location_id as home from (
                    select batch_no, user_id, location_id,
                           row_number() over (partition by batch_no, user_id
                                              order by count(*) desc, location_id) as rn
                    from batched group by batch_no, user_id, location_id) c
                where rn = 1),
            limits as (
                select batch_no, user_id, quantile_cont(amount, 0.95) as p95
                from batched group by batch_no, user_id),
            flags as (
                select b.batch_no, b.pos, b.amount,
                       cast(b.location_id <> h.home as integer)
                       + cast(round(b.amount, 6) > round(l.p95, 6) as integer)
                       + cast(row_number() over (partition by b.batch_no, b.user_id, b.device_id
                                                 order by b.timestamp, b.txn_id) = 1 as integer) as flags
                from batched b
                join bhomes h on b.batch_no = h.batch_no and b.user_id = h.user_id
                join limits l on b.batch_no = l.batch_no and b.user_id = l.user_id),
            rated as (
                select *, (round(amount / (amount + 500.0), 6) + flags) / 4 as score from flags)
            select cast(batch_no as bigint) as batch_no, min(pos) as batch_start_idx,
                   count(*) as batch_size, {_r("avg(score)")} as mean_fraud_proba,
                   {_r("max(score)")} as max_fraud_proba
            from rated group by batch_no""",
        ),
        "transactions_head": _with(
            ["tx"],
            f"""
            select txn_id, user_id, amount, location_id, device_id,
                   {_YES_NO.format("is_fraud", "is_fraud")} as is_fraud,
                   epoch_us(timestamp) as timestamp_us
            from tx order by txn_id limit 5000""",
        ),
        "coerce_numeric": """
            select event_id,
                   coalesce(try_cast(case when event_id % 10 = 0 then event_type
                            else json_extract_string(props, '$.k') end as double), 0) as reading
            from events""",
        "clean_transactions": _with(
            ["txc"],
            f"""
            select txn_id, user_id, {_r("amount")} as amount, location_id, device_id, is_fraud,
                   epoch_us(timestamp) as timestamp_us
            from txc""",
        ),
        "clean_reviews": _with(["reviews_clean"], "select * from reviews_clean"),
        "clean_baskets": _with(["lines_clean"], "select * from lines_clean"),
        "clean_churn": _with(
            ["churn"],
            f"""
            select user_id, tenure_months,
                   {_r("coalesce(monthly_spend, (select quantile_cont(monthly_spend, 0.5) from churn))", 6)}
                   as monthly_spend,
                   sessions_per_month, support_tickets, churned
            from churn""",
        ),
        "clean_ratings": _with(["ratings_clean"], "select * from ratings_clean"),
        "user_home_location": _with(
            ["homes"], "select user_id, home as home_location from homes"
        ),
        "engineer_fraud_features": _with(
            ["feat"],
            """
            select txn_id, user_id, unusual_location, high_spend, new_device, is_fraud from feat""",
        ),
        "feat_high_spend_asof": _with(
            ["txc"],
            f"""
            select txn_id, user_id, {_r("spend_limit")} as spend_limit_asof,
                   cast(coalesce(round(amount, 6) > round(spend_limit, 6), false) as integer)
                       as high_spend_asof
            from (select *, quantile_cont(amount, 0.95) over (
                      partition by user_id order by timestamp, txn_id
                      rows between unbounded preceding and 1 preceding) as spend_limit from txc) f""",
        ),
        "device_occurrence": _with(
            ["tx"],
            """
            select txn_id, user_id, device_id,
                   row_number() over (partition by user_id, device_id
                                      order by timestamp, txn_id) - 1 as occurrence
            from tx""",
        ),
        "user_amount_p95": _with(
            ["txc"],
            f"""
            select user_id, {_r("quantile_cont(amount, 0.95)", 6)} as p95
            from txc group by user_id""",
        ),
        "amount_quantiles": _with(
            ["tx"],
            f"""
            select 'amount_median' as metric, {_r("quantile_cont(amount, 0.5)", 6)} as value from tx
            union all select 'amount_p95', {_r("quantile_cont(amount, 0.95)", 6)} from tx
            union all select 'location_median', {_r("quantile_cont(location_id, 0.5)", 6)} from tx""",
        ),
        "fraud_rate_by_decile": _with(
            ["tx"],
            f"""
            , edges as (
                select distinct round(unnest(quantile_cont(amount,
                       [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1])), 6) as edge from tx),
            binned as (
                select t.txn_id, t.is_fraud,
                       greatest(count(e.edge) - 1, 0) as decile
                from tx t left join edges e on e.edge < round(t.amount, 6)
                group by t.txn_id, t.is_fraud)
            select cast(decile as integer) as decile, {_r("avg(is_fraud)")} as rate, count(*) as n
            from binned group by decile""",
        ),
        "hist_amount_by_fraud": _histogram(
            "tx", ["tx"], "amount", _YES_NO.format("is_fraud", "is_fraud"), 60
        ),
        "hist_polarity": _histogram("sentiments", ["sentiments"], "polarity", "sentiment", 40),
        "hist_churn_score": _histogram(
            "churn",
            ["churn"],
            "(1.0::double / (1.0::double + sessions_per_month))",
            _YES_NO.format("churned", "churned"),
            40,
        ),
        "threshold_counts": _with(
            ["scored"],
            f"""
            select threshold, count(score) filter (where score >= threshold) as n
            from (values {thresholds}) t(threshold), scored group by threshold""",
        ),
        "alert_counts": _with(
            ["scored"],
            """
            select alert, threshold, count(score) filter (where score >= threshold) as n
            from (values ('fraud', cast(0.5 as double)), ('anomaly', cast(0.55 as double))) t(alert, threshold),
                 scored group by alert, threshold""",
        ),
        "findings_check": _with(
            ["tx", "reviews_clean", "sets", "rules", "ratings_clean"],
            f"""
            select 'data_lake' as section, 'transactions_rows' as metric, count(*) as value from tx
            union all select 'data_lake', 'rollup_users', count(*) from (select distinct user_id from tx) u
            union all select 'sentiment', 'n_reviews', count(*) from reviews_clean
            union all select 'market_basket', 'n_frequent_itemsets', count(*) from sets
            union all select 'market_basket', 'n_rules', count(*) from rules where confidence >= {CONFIDENCE}
            union all select 'collaborative_filtering', 'n_users_in_matrix', count(distinct user_id)
                from ratings_clean
            union all select 'collaborative_filtering', 'n_products_in_matrix', count(distinct product_id)
                from ratings_clean
            union all select 'all', 'verdicts', 8""",
        ),
        "lake_counts": _with(
            ["tx", "reviews", "lines", "churn", "ratings", "sets", "rules"],
            f"""
            select 'transactions' as metric, count(*) as value from tx
            union all select 'reviews', count(*) from reviews
            union all select 'order_line_items', count(*) from lines
            union all select 'user_churn_features', count(*) from churn
            union all select 'user_product_ratings', count(*) from ratings
            union all select 'rating_users', count(distinct user_id) from ratings
            union all select 'rating_products', count(distinct product_id) from ratings
            union all select 'frequent_itemsets', count(*) from sets
            union all select 'association_rules', count(*) from rules
                where confidence >= {RULE_CONFIDENCE}""",
        ),
        "lake_manifest": " union all ".join(
            f"select '{t}' as name, '{t}.parquet' as path, 'parquet' as format, "
            f"count(*) as n_rows from {t}"
            for t in ("events", "documents", "lineitem", "customer", "orders")
        ),
        "sentiment_polarity": _with(
            ["sentiments"], "select review_id, polarity, sentiment from sentiments"
        ),
        "sentiment_phrases": _with(
            ["reviews_clean", "scaled"],
            f"""
            select review_id, polarity, cast(n as integer) as polarity_phrases,
                   case when polarity > 0.05 then 'positive' when polarity < -0.05 then 'negative'
                        else 'neutral' end as sentiment
            from (select r.review_id, coalesce(s.n, 0) as n, {_r("coalesce(s.mean, 0)")} as polarity
                  from reviews_clean r left join (
                      select review_id, count(*) as n, sum(value order by pos) / count(*) as mean
                      from scaled group by review_id) s on r.review_id = s.review_id) x""",
        ),
        "sentiment_counts": _with(
            ["sentiments"], "select sentiment, count(*) as n from sentiments group by sentiment"
        ),
        "sentiment_report": _report(
            ["sentiments"],
            """select true_sentiment as label, sentiment as prediction from sentiments
               where true_sentiment is not null""",
        ),
        "sentiment_accuracy": _with(
            ["sentiments"],
            f"""
            select {_r("avg(cast(true_sentiment = sentiment as integer))")} as accuracy, count(*) as n
            from sentiments where true_sentiment is not null""",
        ),
        "basket_build": _with(["baskets"], f"select order_id, {items} from baskets"),
        "item_support": _with(
            ["sets", "total"],
            f"select {items}, freq, {_r('freq / n', 6)} as support from sets, total where len(items) = 1",
        ),
        "pair_itemsets": _with(
            ["sets", "total"],
            f"select {items}, freq, {_r('freq / n', 6)} as support from sets, total where len(items) <= 2",
        ),
        "frequent_itemsets": _with(
            ["sets", "total"], f"select {items}, freq, {_r('freq / n', 6)} as support from sets, total"
        ),
        "pair_rules": _with(
            ["rules"],
            f"""
            select antecedents[1] as antecedent, consequents[1] as consequent,
                   {_r("support", 6)} as support, {_r("confidence", 6)} as confidence, {_r("lift", 6)} as lift
            from rules
            where len(antecedents) = 1 and len(consequents) = 1 and confidence >= {CONFIDENCE}""",
        ),
        "association_rules": _with(
            ["rules"],
            f"""
            select {sides}, {_r("support", 6)} as support, {_r("confidence", 6)} as confidence,
                   {_r("lift", 6)} as lift, {_r("leverage", 6)} as leverage, {_r("conviction", 6)} as conviction
            from rules where confidence >= {RULE_CONFIDENCE}""",
        ),
        "rules_top25_lift": _with(
            ["rules"],
            f"""
            select antecedents, consequents, {_r("support", 6)} as support,
                   {_r("confidence", 6)} as confidence, {_r("lift", 6)} as lift
            from (select {sides}, support, confidence, lift from rules
                  where confidence >= {CONFIDENCE}
                  order by round(lift, 9) desc, 1, 2 limit 25) t""",
        ),
        "cf_matrix": _with(
            ["centred"],
            f"""
            select user_id, product_id, {_r("rating")} as rating, {_r("centred")} as centred
            from centred""",
        ),
        "cf_neighbors": _with(
            ["near"],
            f"""
            select user_id, neighbor_id, {_r("sim")} as sim, cast(rank as integer) as rank
            from near""",
        ),
        "cf_recommend": _with(
            ["recs"],
            f"""
            select user_id, product_id, {_r("score")} as score, cast(rank as integer) as rank
            from recs""",
        ),
        "cf_als_check": _with(
            ["ratings_clean"],
            """
            select n, n as last, n as different, count(*) as users, cast(0 as bigint) as rated
            from (select least(8, (select count(distinct product_id) from ratings_clean)
                                  - count(distinct product_id)) as n
                  from ratings_clean group by user_id) u
            where n > 0 group by n""",
        ),
        "first_15_users": _with(
            ["recs"],
            f"""
            select user_id, product_id, {_r("score")} as score, cast(rank as integer) as rank
            from recs where rank <= 5
              and user_id in (select distinct user_id from recs order by user_id limit 15)""",
        ),
        "own_top_items": _with(
            ["centred"],
            f"""
            select user_id, product_id, {_r("centred")} as score, cast(rank as integer) as rank
            from (select user_id, product_id, centred,
                         row_number() over (partition by user_id
                                            order by round(centred, 9) desc, product_id) as rank
                  from centred where centred > 1e-12) x
            where rank <= 6""",
        ),
        "confusion_matrix": _with(
            ["alarm"],
            "select label, prediction, count(*) as n from alarm group by label, prediction",
        ),
        "classification_report": _report(["alarm"], "select label, prediction from alarm"),
        "roc_auc": _with(
            ["scored"],
            f"""
            , ranked as (
                select is_fraud, rank() over (order by score)
                       + (count(*) over (partition by score) - 1) / 2.0 as mid from scored)
            select {_r('''(sum(mid) filter (where is_fraud = 1)
                          - count(*) filter (where is_fraud = 1)
                            * (count(*) filter (where is_fraud = 1) + 1) / 2.0)
                         / (count(*) filter (where is_fraud = 1)
                            * count(*) filter (where is_fraud = 0))''')} as roc_auc
            from ranked""",
        ),
        "stratified_split_counts": _with(
            ["tx"],
            """
            select is_fraud, case when ('0x' || substr(md5('42:' || txn_id), 1, 8))::bigint < 1073741824
                                  then 'test' else 'train' end as part, count(*) as n
            from tx group by 1, 2""",
        ),
        "balanced_weights": _with(
            ["tx"],
            f"""
            , train as (
                select * from tx
                where ('0x' || substr(md5('42:' || txn_id), 1, 8))::bigint >= 1073741824)
            select is_fraud, count(*) as n,
                   {_r("(select count(*) / count(distinct is_fraud) from train) / count(*)")} as weight
            from train group by is_fraud""",
        ),
        "outlier_flag": _with(
            ["flagged"],
            "select txn_id, score, cast(outlier as integer) as outlier from flagged",
        ),
        "anomalies_top500": _with(
            ["flagged"],
            """
            select txn_id, user_id, score, unusual_location, high_spend, is_fraud
            from flagged order by score desc, txn_id limit 500""",
        ),
        "anomaly_summary": _with(
            ["flagged"],
            f"""
            select count(*) as n_rows, count(*) filter (where outlier) as n_flagged_outliers,
                   {_r("avg(score)")} as mean_anomaly_score,
                   {_r("stddev_pop(score)")} as std_anomaly_score,
                   (select {_r("avg(is_fraud)")} from (
                       select is_fraud from flagged order by score desc, txn_id limit 100) t)
                   as top_100_overlap_with_labeled_fraud
            from flagged""",
        ),
        "whatif_features": _with(
            ["copies_clean"],
            f"""
            , limits as (
                select scenario_id, quantile_cont(amount, 0.95) as p95
                from copies_clean group by scenario_id),
            seen as (
                select scenario_id, device_id, min(added) as first_added
                from copies_clean group by scenario_id, device_id)
            select c.scenario_id, c.user_id, {_r("c.amount")} as amount, c.location_id, c.device_id,
                   cast(c.location_id <> c.home as integer) as unusual_location,
                   coalesce(cast(round(c.amount, 6) > round(l.p95, 6) as integer), 0) as high_spend,
                   cast(s.first_added as integer) as new_device,
                   epoch_us(c.timestamp) as timestamp_us
            from copies_clean c
            join limits l on c.scenario_id = l.scenario_id
            join seen s on c.scenario_id = s.scenario_id and c.device_id = s.device_id
            where c.added = 1""",
        ),
        "whatif_without_history": _with(
            ["tx", "scenarios"],
            """
            select scenario_id, user_id from scenarios
            where user_id not in (select user_id from tx)""",
        ),
        # Scores depend on training; these hold for any model.
        "fraud_score_check": _with(
            ["tx"],
            "select count(*) as n_rows, count(distinct txn_id) as n_keys, count(*) as n_in_range from tx",
        ),
        "stream_event_score_check": _with(
            ["tx"],
            "select count(*) as n_rows, count(distinct txn_id) as n_keys, count(*) as n_in_range from tx",
        ),
        "anomaly_score_check": _with(
            ["tx"],
            "select count(*) as n_rows, count(distinct txn_id) as n_keys, count(*) as n_in_range from tx",
        ),
        "churn_score_check": _with(
            ["churn"],
            "select count(*) as n_rows, count(distinct user_id) as n_keys, count(*) as n_in_range from churn",
        ),
        "whatif_score_check": _with(
            ["tx", "scenarios"],
            """
            select count(*) as n_rows, count(distinct scenario_id) as n_keys, count(*) as n_in_range
            from scenarios where user_id in (select user_id from tx)""",
        ),
        "stream_batch_check": _with(
            ["tx"],
            "select count(*) as n_rows, count(*) as n_positions, cast(0 as bigint) as n_out_of_range from tx",
        ),
        "fraud_report_support": _with(
            ["tx"],
            """
            select cast(is_fraud as varchar) as class, count(*) as support from tx
            where ('0x' || substr(md5('42:' || txn_id), 1, 8))::bigint < 1073741824 group by 1""",
        ),
        "stream_event_features": _with(
            ["tx", "homes"],
            """
            select t.txn_id, t.user_id, coalesce(t.location_id, h.home) as location_id,
                   case when t.location_id is null then 1
                        else cast(t.location_id <> coalesce(h.home, t.location_id) as integer) end
                   as unusual_location,
                   cast(t.amount > 500 as integer) as high_spend,
                   cast(row_number() over (partition by t.user_id, t.device_id
                                           order by t.timestamp, t.txn_id) = 1 as integer) as new_device
            from tx t left join homes h on t.user_id = h.user_id""",
        ),
        "stream_dedup_devices": _with(["tx"], "select distinct user_id, device_id from tx"),
        "stream_user_recs": _with(
            ["tx", "recs"],
            f"""
            select t.txn_id, t.user_id, r.product_id, {_r("r.score")} as score,
                   cast(r.rank as integer) as rank
            from tx t join recs r on t.user_id = r.user_id where r.rank <= 6""",
        ),
        "stream_windowed_fraud": _with(
            ["tx"],
            f"""
            select txn_count, total_amount, fraud_count, epoch_us(start) as window_start_us
            from (select date_trunc('hour', timestamp) as start, count(*) as txn_count,
                         {_r("sum(amount)")} as total_amount, cast(sum(is_fraud) as bigint) as fraud_count
                  from tx group by 1) w""",
        ),
    }
