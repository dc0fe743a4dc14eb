"""The SQL each query is checked against, for DuckDB over the same tables."""

from __future__ import annotations

SEED = 42
VOCABULARY = 3000
BATCH = 100
ROWS_PER_SHARD = 10_000
SIZE = 32

BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
RUN = r"'[ \t\n\x0B\f\r]+'"


def md5_int(key: str, at: int, digits: int = 8) -> str:
    return f"cast('0x' || substr(md5({key}), {at}, {digits}) as bigint)"


def key(*parts: str) -> str:
    return f"concat_ws(':', '{SEED}', {', '.join(parts)})"


def uniform(k: str, at: int) -> str:
    return f"(({md5_int(k, at)} + 1) / 4294967297.0::double)"


def gauss(k: str) -> str:
    return f"(sqrt(-2.0::double * ln({uniform(k, 1)})) * cos(2.0::double * pi() * {uniform(k, 9)}))"


def micro(x: str) -> str:
    return f"cast(round(({x}) * 1e6) as bigint)"


def joined(x: str) -> str:
    return f"array_to_string({x}, ' ')"


def joined_reals(x: str) -> str:
    return f"array_to_string(list_transform({x}, lambda v: {micro('v')}), ' ')"


def lines(name: str, table: str, doc: str, text: str = "text") -> str:
    return f"""{name}_parts as (
      select {doc} as doc_id,
        case when rtrim({text}, chr(10)) = '' and {text} <> '' then cast([] as varchar[])
             else string_split(rtrim({text}, chr(10)), chr(10)) end as parts from {table}),
    {name} as (
      select doc_id, i - 1 as line_no, parts[i] as line
      from (select doc_id, parts, generate_subscripts(parts, 1) as i from {name}_parts))"""


DOCS = lines("doc_lines", "documents", "doc_id")
TURN_KEY = "conv_id * (select max(turn) + 1 from conversations) + turn"
TURNS = lines("turn_lines", "conversations", TURN_KEY)


def words(line: str) -> str:
    return f"""case when rtrim({line}, {BLANKS}) = '' and {line} <> '' then cast([] as varchar[])
             else string_split_regex(rtrim({line}, {BLANKS}), {RUN}) end"""


def tokens(name: str, source: str) -> str:
    return f"""{name} as (
      select doc_id, line_no, cast(i - 1 as integer) as pos, w[i] as word from (
        select doc_id, line_no, w, generate_subscripts(w, 1) as i
        from (select doc_id, line_no, {words('line')} as w from {source})))"""


def vocab(name: str, source: str) -> str:
    return f"""{name} as (
      select word, row_number() over (order by first) - 1 as id
      from (select word, min(row(doc_id, line_no, pos)) as first from {source} group by word))"""


def encoded(name: str, source: str, words_table: str) -> str:
    return f"""{name} as (
      select doc_id, line_no, pos, t.word, coalesce(v.id, 0) as id, v.id is null as is_oov
      from {source} t left join {words_table} v on t.word = v.word)"""


def windows(name: str, source: str, width: int) -> str:
    """A window ends at each position past the first `width`, or at the end of a shorter line."""
    ids = ", ".join(f"lag(id, {n}) over line" for n in range(width, 0, -1))
    return f"""{name}_all as (
      select doc_id, line_no, pos, id as label, [{ids}] as before, count(*) over (partition by doc_id, line_no) as size
      from {source} window line as (partition by doc_id, line_no order by pos)),
    {name} as (
      select doc_id, line_no, case when size > {width} then pos - {width} else 0 end as k,
        list_filter(before, lambda x: x is not null) as context, label, size <= {width} as is_partial
      from {name}_all where pos >= {width} or (size <= {width} and pos = size - 1))"""


DOC_TOKENS = f"{DOCS}, {tokens('doc_tokens', 'doc_lines')}"
DOC_VOCAB = f"{DOC_TOKENS}, {vocab('doc_vocab', 'doc_tokens')}"
DOC_IDS = f"{DOC_VOCAB}, {encoded('doc_ids', 'doc_tokens', 'doc_vocab')}"
TURN_TOKENS = f"{TURNS}, {tokens('turn_tokens', 'turn_lines')}"
TURN_VOCAB = f"{TURN_TOKENS}, {vocab('turn_vocab', 'turn_tokens')}"
TURN_IDS = f"{TURN_VOCAB}, {encoded('turn_ids', 'turn_tokens', 'turn_vocab')}"
# Whole turns as single lines, for seeds.
SEEDS = f"seed_lines as (select {TURN_KEY} as doc_id, 0 as line_no, text as line from conversations)"
SEED_TOKENS = f"{SEEDS}, {tokens('seed_tokens', 'seed_lines')}"

IS_TRAIN = f"{md5_int(key('doc_id', 'line_no'), 1)} % 100 < 80"


def position(pos: str, dim: str, size: int = SIZE) -> str:
    angle = f"({pos} / pow(10000.0::double, 2 * {dim} / {size}.0::double))"
    return f"(case when {dim} % 2 = 0 then sin({angle}) else cos({angle}) end)"


def vectors(name: str, ids: str, positions: int) -> str:
    """Token vectors with each position's values added: one list column x0, x1... per position."""
    columns = ", ".join(
        f"[{', '.join(f't[{d + 1}] + {position(str(p), str(d))}' for d in range(SIZE))}] as x{p}" for p in range(positions)
    )
    return f"""{name}_plain as materialized (
      select id, list_transform(range({SIZE}), lambda d: {gauss(key('id', 'd'))} * 0.1::double) as t
      from (select distinct id from {ids})),
    {name} as materialized (select id, {columns} from {name}_plain)"""


def attention(source: str, keys: str, rows: list[str], size: int) -> str:
    """softmax(X Xt / sqrt(size)) X for list columns, flattened into `features`."""
    n = range(len(rows))
    scores = ", ".join(f"list_dot_product({rows[i]}, {rows[j]}) / sqrt({size}.0::double) as s{i}_{j}" for i in n for j in n)
    tops = ", ".join("greatest(" + ", ".join(f"s{i}_{j}" for j in n) + f") as m{i}" for i in n)
    weights = ", ".join(f"exp(s{i}_{j} - m{i}) as e{i}_{j}" for i in n for j in n)
    outs = [
        f"list_transform(range(1, {size + 1}), lambda d: ("
        + " + ".join(f"e{i}_{j} * {rows[j]}[d]" for j in n)
        + ") / (" + " + ".join(f"e{i}_{j}" for j in n) + "))"
        for i in n
    ]
    names = ", ".join(rows)
    return f"""scores as (select {keys}, {names}, {scores} from {source}),
    tops as (select *, {tops} from scores),
    weights as (select {keys}, {names}, {weights} from tops),
    attended as (select {keys}, {' || '.join(outs)} as features from weights)"""


def reshaped_attention(count: int) -> str:
    size = 64 // count
    parts = ", ".join(
        f"cast(embedding[{i * size + 1}:{(i + 1) * size}] as double[]) as x{i}" for i in range(count)
    )
    return f"""with rows as (select vec_id, {parts} from embeddings),
    {attention('rows', 'vec_id', [f'x{i}' for i in range(count)], size)}
    select vec_id, {joined_reals('features')} as features from attended"""


def projected_attention(rows: int, size: int) -> str:
    """Attention over rows of the embeddings with seeded query, key and value matrices, cell by cell."""
    return f"""with mats as materialized (
      select name, i, j, {gauss(key('name', 'i', 'j'))} / sqrt({size}.0::double) as w
      from (values ('q'), ('k'), ('v')) n(name), range({size}) a(i), range({size}) b(j)),
    cells as (select vec_id, (place - 1) // {size} as r, (place - 1) % {size} as i, x from (
      select vec_id, generate_subscripts(embedding, 1) as place, unnest(cast(embedding as double[])) as x from embeddings)),
    made as materialized (select name, vec_id, r, j, sum(x * w) as x from cells join mats using (i) group by all),
    scores as (select q.vec_id, q.r, k.r as other, sum(q.x * k.x) / sqrt({size}.0::double) as s
      from made q join made k on q.vec_id = k.vec_id and q.j = k.j where q.name = 'q' and k.name = 'k' group by all),
    raised as (select *, exp(s - max(s) over (partition by vec_id, r)) as e from scores),
    weights as (select *, e / sum(e) over (partition by vec_id, r) as p from raised),
    outs as (select w.vec_id, w.r * {size} + v.j as place, sum(w.p * v.x) as x
      from weights w join made v on v.vec_id = w.vec_id and v.r = w.other where v.name = 'v' group by all)
    select vec_id, string_agg(cast({micro('x')} as varchar), ' ' order by place) as features from outs group by vec_id"""


EMB = "emb as (select vec_id, label, cast(embedding as double[]) as v from embeddings)"
PROBS = f"""{EMB},
    cells as (select vec_id, generate_subscripts(v, 1) as i, unnest(v) as x from emb),
    raised as (select vec_id, i, exp(x - max(x) over (partition by vec_id)) as e from cells),
    probs as (select vec_id, i, e / sum(e) over (partition by vec_id) as p from raised)"""
SCALED = f"""{PROBS},
    hot as (select vec_id, i, exp(p / 0.7::double) as e from probs),
    scaled as (select vec_id, i, e / sum(e) over (partition by vec_id) as p from hot)"""


def network(sizes: list[int]) -> str:
    """Forward pass of the seeded initial network over the embeddings, one table per layer."""
    parts = [EMB, "act0 as (select vec_id, generate_subscripts(v, 1) - 1 as i, unnest(v) as x from emb)"]
    for layer, (fan_in, fan_out) in enumerate(zip(sizes, sizes[1:])):
        weight = f"{gauss(key(str(layer), 'i', 'j'))} * sqrt(2.0::double / {fan_in + fan_out})"
        last = layer == len(sizes) - 2
        total = "sum(a.x * w.w)"
        parts.append(
            f"w{layer} as materialized (select i, j, {weight} as w from range({fan_in}) a(i), range({fan_out}) b(j))"
        )
        parts.append(
            f"""act{layer + 1} as materialized (select vec_id, j as i, {total if last else f'greatest({total}, 0)'} as x
              from act{layer} a join w{layer} w on a.i = w.i group by vec_id, j)"""
        )
    out = f"act{len(sizes) - 1}"
    parts.append(
        f"""best as (select vec_id, max(x) as top from {out} group by vec_id),
        tops as (select b.vec_id, top, min(i) as prediction
                 from best b join {out} o on o.vec_id = b.vec_id and o.x = b.top group by b.vec_id, top),
        sums as (select o.vec_id, any_value(top) as top, any_value(prediction) as prediction,
                 any_value(top) + ln(sum(exp(x - top))) as logsum
                 from {out} o join tops t on o.vec_id = t.vec_id group by o.vec_id),
        scored as (select s.vec_id, e.label, prediction, exp(top - logsum) as prob, logsum - o.x as nll
                   from sums s join emb e on e.vec_id = s.vec_id
                   join {out} o on o.vec_id = s.vec_id and o.i = e.label)"""
    )
    return ",\n".join(parts)


NETWORK = network([64, 8, 8, 10])
LOG = """log as (select quality as epoch, (doc_id % 97) / 10.0::double as loss,
      cast(quality = toxic as bigint) as correct, 1 as total from labels)"""
TOTALS = f"""{LOG}, totals as (select epoch, sum(loss) as total_loss, cast(sum(correct) as bigint) as correct,
      cast(sum(total) as bigint) as predictions, count(*) as batches from log group by epoch)"""
CLASSES = """classes as (select quality as c from labels union select toxic from labels),
    per_class as (
      select c as class_id, count(*) filter (quality = c) as support,
        coalesce(count(*) filter (quality = c and toxic = c) / nullif(count(*) filter (toxic = c), 0)::double, 0) as precision,
        coalesce(count(*) filter (quality = c and toxic = c) / nullif(count(*) filter (quality = c), 0)::double, 0) as recall
      from labels, classes group by c),
    scored as (select *, case when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0 end as f1
      from per_class)"""



def batches(rows: str) -> str:
    """Each sample of `rows` in its shard and batch."""
    shard = f"""cast({md5_int(key('doc_id', 'line_no', 'k'), 17, 15)}
      % (select (count(*) + {ROWS_PER_SHARD - 1}) // {ROWS_PER_SHARD} from chosen) as integer)"""
    return f"""chosen as ({rows}),
    sharded as (select doc_id, line_no, k, label, {shard} as shard from chosen),
    batched as (select *, (row_number() over (partition by shard order by doc_id, line_no, k) - 1) // {BATCH} as batch_no
      from sharded)"""


WINDOW_COLUMNS = f"doc_id, line_no, k, {joined('context')} as context, label, is_partial"

ORACLES: dict[str, str] = {
    "split_lines": f"with {DOCS} select doc_id, line_no, line from doc_lines",
    "corpus_adapter": f"with {TURNS} select doc_id, line_no, line from turn_lines",
    "corpus_stats": f"""with {DOCS} select count(*) as lines,
        cast(sum(len({words('line')})) as bigint) as words from doc_lines""",
    "train_val_split": f"with {DOCS} select doc_id, line_no, {IS_TRAIN} as is_train from doc_lines",
    "distinct_words": f"""with {DOC_TOKENS}
        select word, first.doc_id as doc_id, first.line_no as line_no, first.pos as pos, n from (
          select word, min({{'doc_id': doc_id, 'line_no': line_no, 'pos': pos}}) as first, count(*) as n
          from doc_tokens group by word)""",
    "tokenize": f"""with {DOCS} select doc_id, line_no, cast(len(w) as integer) as n_words, array_to_string(w, '|') as words
        from (select doc_id, line_no, {words('line')} as w from doc_lines)""",
    "explode_tokens": f"with {DOC_TOKENS} select doc_id, line_no, pos, word from doc_tokens",
    "fit_vocab": f"with {DOC_VOCAB} select word, id from doc_vocab",
    "extend_vocab": f"""with {TURN_VOCAB}, {DOC_TOKENS},
        fresh as (select * from doc_tokens where word not in (select word from turn_vocab)),
        {vocab('added', 'fresh')}
        select word, id from turn_vocab
        union all select word, id + (select count(*) from turn_vocab) from added""",
    "encode": f"""with {DOC_IDS}
        select l.doc_id, l.line_no, coalesce(string_agg(cast(id as varchar), ' ' order by pos), '') as ids,
          count(*) filter (is_oov) as oov_count
        from doc_lines l left join doc_ids i on l.doc_id = i.doc_id and l.line_no = i.line_no
        group by l.doc_id, l.line_no""",
    "encode_oov": f"""with {DOC_TOKENS}, {TURN_VOCAB}, {encoded('ids', 'doc_tokens', 'turn_vocab')}
        select doc_id, line_no, pos, word, id, is_oov from ids""",
    "decode": f"""with {DOC_IDS}
        select l.doc_id, l.line_no,
          coalesce(string_agg(word, ' ' order by pos), '') as text
        from doc_lines l left join doc_ids i on l.doc_id = i.doc_id and l.line_no = i.line_no
        group by l.doc_id, l.line_no""",
    "decode_unknown": f"""with {DOC_IDS}, {TURNS}, {tokens('turn_tokens', 'turn_lines')}, {vocab('turn_vocab', 'turn_tokens')}
        select l.doc_id, l.line_no,
          coalesce(string_agg(coalesce(v.word, ''), ' ' order by pos) filter (i.id is not null), '') as text
        from doc_lines l left join doc_ids i on l.doc_id = i.doc_id and l.line_no = i.line_no
        left join turn_vocab v on v.id = i.id group by l.doc_id, l.line_no""",
    "normalize_ws": f"select doc_id, regexp_replace(text, {RUN}, ' ', 'g') as text from documents",
    "sliding_windows_w1": f"with {DOC_IDS}, {windows('w', 'doc_ids', 1)} select {WINDOW_COLUMNS} from w",
    "sliding_windows_w3": f"with {DOC_IDS}, {windows('w', 'doc_ids', 3)} select {WINDOW_COLUMNS} from w",
    "partial_windows": f"with {DOC_IDS}, {windows('w', 'doc_ids', 5)} select {WINDOW_COLUMNS} from w where is_partial",
    "training_samples": f"""with {DOC_IDS}, {windows('w', 'doc_ids', 1)}
        select {WINDOW_COLUMNS} from w where {IS_TRAIN}""",
    "minibatches": f"""with {DOC_IDS}, {windows('w', 'doc_ids', 1)},
        sharded as (select doc_id, line_no, k,
          cast({md5_int(key('doc_id', 'line_no', 'k'), 17, 15)}
            % (select (count(*) + {ROWS_PER_SHARD - 1}) // {ROWS_PER_SHARD} from w) as integer) as shard from w)
        select doc_id, line_no, k, shard,
          (row_number() over (partition by shard order by doc_id, line_no, k) - 1) // {BATCH} as batch_no
        from sharded""",
    "label_onehot": f"""with {DOC_IDS}, {windows('w', 'doc_ids', 1)}
        select doc_id, line_no, k, label, {VOCABULARY} as width,
          cast(case when label < {VOCABULARY} then label else -1 end as integer) as hot_index from w""",
    "token_embedding": f"""with {DOC_VOCAB}
        select id, {joined_reals(f"list_transform(range({SIZE}), lambda d: {gauss(key('id', 'd'))} * 0.1::double)")} as vector
        from doc_vocab""",
    "positional_encoding": f"""with {TURN_TOKENS},
        places as (select distinct pos from turn_tokens),
        encodings as (select pos,
          {joined_reals(f"list_transform(range({SIZE}), lambda d: {position('pos', 'd')})")} as encoding from places)
        select doc_id, line_no, t.pos, encoding from turn_tokens t join encodings e on t.pos = e.pos""",
    "embedding_matrix": f"""with {TURN_IDS}, {windows('w', 'turn_ids', 2)}, {vectors('vec', 'turn_ids', 2)}
        select doc_id, line_no, k, {joined_reals('coalesce(a.x0, []) || coalesce(b.x1, [])')} as matrix
        from w left join vec a on w.context[1] = a.id left join vec b on w.context[2] = b.id""",
    "self_attention_w2": reshaped_attention(2),
    "self_attention_w4": reshaped_attention(4),
    "self_attention_w16": reshaped_attention(16),
    "self_attention_projected": projected_attention(2, 32),
    "softmax": f"""with {PROBS}
        select vec_id, string_agg(cast({micro('p')} as varchar), ' ' order by i) as probs from probs group by vec_id""",
    "sample_features": f"""with {DOC_IDS}, {windows('w', 'doc_ids', 1)}, {vectors('vec', 'doc_ids', 1)},
        texts as materialized (select id, {joined_reals('x0')} as features from vec)
        select doc_id, line_no, k, coalesce(features, repeat('0 ', {SIZE - 1}) || '0') as features,
          cast(not is_partial as integer) as mask
        from w left join texts on w.context[1] = texts.id""",
    "sample_features_w3": f"""with {TURN_IDS}, {windows('w', 'turn_ids', 3)}, {vectors('vec', 'turn_ids', 3)},
        filled as (select doc_id, line_no, k, a.x0, b.x1, c.x2 from w
          join vec a on w.context[1] = a.id join vec b on w.context[2] = b.id join vec c on w.context[3] = c.id
          where not is_partial),
        {attention('filled', 'doc_id, line_no, k', ['x0', 'x1', 'x2'], SIZE)}
        select w.doc_id, w.line_no, w.k,
          case when is_partial then repeat('0 ', {3 * SIZE - 1}) || '0' else {joined_reals('features')} end as features,
          cast(not is_partial as integer) as mask
        from w left join attended a on w.doc_id = a.doc_id and w.line_no = a.line_no and w.k = a.k""",
    "average_params": f"""with {EMB},
        cells as (select label, generate_subscripts(v, 1) as i, unnest(v) as x from emb),
        means as (select label, i, count(*) as n, avg(x) as x from cells group by label, i)
        select label, any_value(n) as n, string_agg(cast({micro('x')} as varchar), ' ' order by i) as mean
        from means group by label""",
    "predict": f"""with {NETWORK}
        select vec_id, prediction, {micro('prob')} as prob, {micro('nll')} as nll from scored""",
    "loss": f"""with {NETWORK}
        select cast(label as bigint) as label, count(*) as rows, {micro('sum(nll) / count(*)')} as loss from scored group by all""",
    "batch_totals": f"""with {TOTALS}
        select epoch, {micro('total_loss')} as total_loss, correct, predictions, batches from totals""",
    "epoch_accuracy": f"""with {TOTALS}
        select epoch, {micro('total_loss / batches')} as avg_loss,
          {micro('case when predictions > 0 then correct / predictions::double else 0 end')} as accuracy from totals""",
    "confusion_counts": "select quality as label, toxic as prediction, count(*) as n from labels group by all",
    "class_metrics": f"""with {CLASSES}
        select class_id, support, {micro('precision')} as precision, {micro('recall')} as recall, {micro('f1')} as f1
        from scored""",
    "evaluation": f"""with {CLASSES}
        select cast(sum(support) as bigint) as n,
          (select {micro("count(*) filter (quality = toxic) / count(*)::double")} from labels) as accuracy,
          {micro('sum(precision * support) / sum(support)')} as precision,
          {micro('sum(recall * support) / sum(support)')} as recall,
          {micro('sum(f1 * support) / sum(support)')} as f1
        from scored""",
    "partition_count": f"with {DOCS} select count(*) as rows, true as has_partitions from doc_lines",
    "train_batches": f"""with {DOC_IDS}, {windows('w', 'doc_ids', 1)}, {batches(f'select * from w where {IS_TRAIN}')}
        select shard, batch_no, count(*) as total from batched group by all""",
    "epoch_counts": f"""with {TURN_IDS}, {windows('w', 'turn_ids', 1)}, {batches(f'select * from w where {IS_TRAIN}')},
        counted as (select count(distinct (shard, batch_no)) as batches, count(*) as predictions,
          cast((count(*) + {ROWS_PER_SHARD - 1}) // {ROWS_PER_SHARD} as integer) as shards,
          count(*) filter (k = 0) as lines, count(*) filter (label >= {VOCABULARY}) as out_of_range from batched)
        select cast(epoch as integer) as epoch, round(0.005::double * pow(0.9::double, epoch - 1), 6) as learning_rate,
          batches, predictions, shards, batches as snapshots, lines, out_of_range
        from counted, range(1, 11) e(epoch)""",
    "seed_context": f"""with {DOC_VOCAB}, {SEED_TOKENS}, {encoded('ids', 'seed_tokens', 'doc_vocab')},
        ranked as (select doc_id, pos, id, row_number() over (partition by doc_id order by pos desc) as r from ids)
        select s.doc_id as seed_row, coalesce(string_agg(cast(id as varchar), ' ' order by pos), '') as context
        from seed_lines s left join ranked r on s.doc_id = r.doc_id and r.r <= 3 group by s.doc_id""",
    "temperature_probs": f"""with {SCALED}
        select vec_id, string_agg(cast({micro('p')} as varchar), ' ' order by i) as probs from scaled group by vec_id""",
    "sample_token": f"""with {SCALED},
        running as (select vec_id, i, sum(p) over (partition by vec_id order by i) as reached from scaled)
        select vec_id, cast(coalesce(min(i) filter (reached >= {uniform(key('vec_id', '0'), 1)}), 1) - 1 as integer) as token
        from running group by vec_id""",
    "format_generated": f"""with {SEED_TOKENS}, {vocab('words', 'seed_tokens')}, {encoded('ids', 'seed_tokens', 'words')},
        texts as (select s.doc_id, any_value(s.line) as line,
          coalesce(string_agg(word, ' ' order by pos), '') as text
          from seed_lines s left join ids i on s.doc_id = i.doc_id group by s.doc_id)
        select doc_id as seed_row,
          'Generated text: ' || line || ' -> ' || regexp_replace(text, {RUN}, ' ', 'g') as output from texts""",
}

# One full-batch step of a small network on the training lines of all conversations, as tables. Features depend on the
# context's token alone, so passes run over distinct contexts; context -1 stands for partial windows.
STEP_SIZES = [4, 8, 8, 10]
STEP_RATE = 0.005


def step_forward(name: str, contexts: str, weights: list[str], keys: str = "") -> str:
    """Activations {name}0..{name}3 of contexts (by keys), with weight tables of (keys,) i, j, w; i = -1 is the bias."""
    by = f"{keys}, " if keys else ""
    match = " and ".join([f"a.{k.strip()} = w.{k.strip()}" for k in keys.split(",")] + [""]) if keys else ""
    prefix = "".join(f"a.{k.strip()}, " for k in keys.split(",")) if keys else ""
    out = [
        f"""{name}0 as materialized (select {by}ctx, i, x from {contexts} c join features f using (ctx)
            union all select {by}ctx, -1, 1.0::double from {contexts})"""
    ]
    for layer, table in enumerate(weights):
        last = layer == len(weights) - 1
        total = "sum(a.x * w.w)"
        body = f"""select {prefix}a.ctx, w.j as i, {total if last else f'greatest({total}, 0)'} as x
            from {name}{layer} a join {table} w on {match}a.i = w.i group by all"""
        if not last:
            body += f" union all select distinct {by}ctx, -1, 1.0::double from {name}{layer}"
        out.append(f"{name}{layer + 1} as materialized ({body})")
    top = f"{name}{len(weights)}"
    out.append(f"""{name}_p as materialized (
        select {by}ctx, i, x, exp(x - top) / sum(exp(x - top)) over (partition by {by}ctx) as p,
          top + ln(sum(exp(x - top)) over (partition by {by}ctx)) - x as nll
        from (select *, max(x) over (partition by {by}ctx) as top from {top}))""")
    out.append(f"""{name}_best as materialized (select {by}ctx, min(i) as prediction from (
        select *, max(x) over (partition by {by}ctx) as top from {top}) where x = top group by all)""")
    return ",\n".join(out)


def step_tables() -> str:
    inputs, hidden, _, outputs = STEP_SIZES
    shard = f"""cast({md5_int(key('doc_id', 'line_no', 'k'), 17, 15)}
      % (select (count(*) + {ROWS_PER_SHARD - 1}) // {ROWS_PER_SHARD} from chosen) as integer)"""
    parts = [
        TURN_IDS,
        windows("w", "turn_ids", 1),
        f"""marked as materialized (select doc_id, line_no, k, coalesce(context[1], -1) as ctx, label,
          least(label, {outputs - 1}) as y, {IS_TRAIN} as is_train from w)""",
        "chosen as (select * from marked where is_train)",
        f"""counts as materialized (select shard, ctx, y, count(*) as n from (select {shard} as shard, ctx, y from chosen)
          group by all)""",
        "sizes as (select shard, sum(n) as n from counts group by all)",
        f"""tokens_used as (select distinct id as ctx from turn_ids union select unnest(range({outputs})))""",
        f"""features as materialized (select ctx, i, {gauss(key('ctx', 'i'))} * 0.1::double
            + {position('0', 'i', inputs)} as x from tokens_used, range({inputs}) r(i)
          union all select -1, i, 0.0::double from range({inputs}) r(i))""",
    ]
    for layer, (fan_in, fan_out) in enumerate(zip(STEP_SIZES, STEP_SIZES[1:])):
        weight = f"{gauss(key(str(layer), 'i', 'j'))} * sqrt(2.0::double / {fan_in + fan_out})"
        parts.append(f"""w{layer} as materialized (select i, j, {weight} as w from range({fan_in}) a(i), range({fan_out}) b(j)
          union all select -1, j, 0.0::double from range({fan_out}) b(j))""")
    parts += [
        "used as (select distinct ctx from counts)",
        step_forward("a", "used", ["w0", "w1", "w2"]),
        # Partial windows are counted in n, and neither learn nor cost.
        """full_counts as (select shard, ctx, y, c.n, s.n as size from counts c join sizes s using (shard) where ctx >= 0)""",
        """losses as (select shard, sum(c.n * p.nll) / any_value(size) as loss
          from full_counts c join a_p p on p.ctx = c.ctx and p.i = c.y group by shard)""",
        """d3 as materialized (select g.shard, g.ctx, p.i as j, (g.n * p.p - coalesce(c.n, 0)) / g.size as d
          from (select shard, ctx, sum(n) as n, any_value(size) as size from full_counts group by all) g
          join a_p p on p.ctx = g.ctx left join full_counts c on c.shard = g.shard and c.ctx = g.ctx and c.y = p.i)""",
    ]
    for layer in (2, 1, 0):
        parts.append(f"""g{layer} as materialized (select shard, a.i, d.j, sum(a.x * d.d) as g
          from d{layer + 1} d join a{layer} a using (ctx) group by all)""")
        if layer:
            parts.append(f"""d{layer} as materialized (select d.shard, d.ctx, w.i as j, sum(d.d * w.w) as d
              from d{layer + 1} d join w{layer} w on w.j = d.j join a{layer} a on a.ctx = d.ctx and a.i = w.i
              where w.i >= 0 and a.x > 0 group by all)""")
    for layer in range(3):
        # Adam's first step moves each parameter by the rate, but for gradients near zero.
        parts.append(f"""all{layer} as (select shard, i, j, w, coalesce(g, 0) as g
          from (select distinct shard from sizes) cross join w{layer} left join g{layer} using (shard, i, j))""")
        parts.append(f"""u{layer} as materialized (select shard, i, j, w - {STEP_RATE}::double * g / (abs(g) + 1e-8::double) as w
          from all{layer})""")
        parts.append(f"m{layer} as materialized (select i, j, avg(w) as w from u{layer} group by all)")
    return ",\n".join(parts)


STEP = step_tables()
STEP_PARAMS = """params as (select shard, g from all0 union all select shard, g from all1 union all select shard, g from all2)"""


def step_blocks() -> str:
    rows = []
    for layer, (fan_in, fan_out) in enumerate(zip(STEP_SIZES, STEP_SIZES[1:])):
        rows.append(f"select {layer} as layer, 'weight' as name, i * {fan_out} + j as place, w from m{layer} where i >= 0")
        rows.append(f"select {layer}, 'bias', j as place, w from m{layer} where i = -1")
    return " union all ".join(rows)


# Scores of a context after the step: running sums of softmax(p / 0.7) over the outputs.
STEP_NEXT = f"""{step_forward('v', 'tokens_used', ['m0', 'm1', 'm2'])},
    heated as (select ctx, i, exp(p / 0.7::double) as e from v_p),
    reached as materialized (select ctx, list(r order by i) as reached from (
      select ctx, i, sum(e) over (partition by ctx order by i) / sum(e) over (partition by ctx) as r from heated) group by ctx),
    {SEED_TOKENS}, {encoded('seed_ids', 'seed_tokens', 'turn_vocab')},
    starts as (select s.doc_id as seed_row, any_value(s.line) as seed, max_by(id, pos) as ctx
      from seed_lines s left join seed_ids i on s.doc_id = i.doc_id group by s.doc_id)"""


def step_draw(ctx: str, step: str) -> str:
    return f"""coalesce(list_position(list_transform(reached, lambda r: r >= {uniform(key('seed_row', step), 1)}), true), 1) - 1"""


def class_scores(pairs: str, nested: bool = False) -> str:
    """Weighted class metrics of a table of label, prediction; nested, as a query of its own."""
    return f"""{'with ' if nested else ''}pairs as materialized ({pairs}),
    classes as (select label as c from pairs union select prediction from pairs),
    per_class as (select c,
        (select count(*) from pairs where label = c) as support,
        coalesce((select count(*) from pairs where label = c and prediction = c)
          / nullif((select count(*) from pairs where prediction = c), 0)::double, 0) as precision,
        coalesce((select count(*) from pairs where label = c and prediction = c)
          / nullif((select count(*) from pairs where label = c), 0)::double, 0) as recall from classes),
    rated as (select *, case when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0 end as f1
      from per_class)
    select cast(sum(support) as bigint) as n, {micro('sum(precision * support) / sum(support)')} as precision,
      {micro('sum(recall * support) / sum(support)')} as recall, {micro('sum(f1 * support) / sum(support)')} as f1,
      {micro('sum(recall * support) / sum(support)')} as accuracy from rated"""


STEP_ORACLES = {
    "step_model": f"""with {STEP}, blocks as ({step_blocks()})
        select 1 as epoch, layer, name, cast(place // 64 as integer) as block_id, cast(count(*) as integer) as n,
          string_agg(cast({micro('w')} as varchar), ' ' order by place) as "values" from blocks group by all""",
    "step_metrics": f"""with {STEP}, {step_forward('b', '(select distinct shard, ctx from counts)', ['u0', 'u1', 'u2'], 'shard')},
        hits as (select sum(n) as correct from counts c join b_best b using (shard, ctx) where b.prediction = c.y)
        select 1 as epoch, 0.005::double as learning_rate, (select round(avg(loss), 4) from losses) as avg_loss,
          round((select correct from hits) / (select sum(n) from sizes)::double * 100, 2) as accuracy_pct,
          (select count(*) from sizes) as batches, (select cast(sum(n) as bigint) from sizes) as predictions,
          (select cast(count(*) as integer) from sizes) as shards, (select count(*) from sizes) as snapshots,
          (select count(*) from chosen where k = 0) as lines,
          (select count(*) from chosen where label >= {STEP_SIZES[-1] - 1}) as out_of_range""",
    "step_gradients": f"""with {STEP}, {STEP_PARAMS},
        by_shard as (select shard, avg(g) as mean, max(g) as top, min(g) as low from params group by shard)
        select 1 as epoch, {micro('avg(mean)')} as grad_mean, {micro('max(top)')} as grad_max, {micro('min(low)')} as grad_min,
          count(*) as recorded from by_shard""",
    "step_validation": f"""with {STEP}, held as (select distinct ctx from marked where not is_train),
        {step_forward('h', 'held', ['m0', 'm1', 'm2'])},
        {class_scores('select y as label, prediction from marked join h_best using (ctx) where not is_train')}""",
    "step_next_token": f"""with {STEP}, {STEP_NEXT}
        select seed_row, case when ctx is null then -1 else cast({step_draw('ctx', "'0'")} as bigint) end as token
        from starts left join reached using (ctx)""",
    "step_generate": f"""with recursive {STEP}, {STEP_NEXT},
        chain as (
          select seed_row, ctx as said, ctx, 0 as step from starts where ctx is not null
          union all
          select seed_row, t, case when t < {STEP_SIZES[-1] - 1} then t else 0 end, step + 1 from (
            select seed_row, step, {step_draw('c.ctx', 'cast(step as varchar)')} as t
            from chain c join reached r on r.ctx = c.ctx where step < 20)),
        texts as (select seed_row, string_agg(case when said < {STEP_SIZES[-1] - 1} then coalesce(word, '') else '' end, ' ' order by step) as text
          from chain left join turn_vocab on id = said where step > 0 group by seed_row)
        select s.seed_row, 'Generated text: ' || s.seed || ' -> ' || regexp_replace(coalesce(text, ''), {RUN}, ' ', 'g') as output
        from starts s left join texts using (seed_row)""",
}

ORACLES |= STEP_ORACLES


# Several steps of the same network, one after the other, for two epochs: Adam's moments go from batch to batch of a shard,
# the model is the mean of the parameters after every batch, and the next epoch starts from it with fresh moments.
RUN_EPOCHS, RUN_STEPS = 2, 3


GOLDEN = 0x9E3779B97F4A7C15
DROPPED = int(0.2 * (1 << 24))


def mixed(x: str) -> str:
    """64-bit arithmetic in 128 bits: each product is below 2^128 and cut to 64."""
    word = "18446744073709551616::uhugeint"
    bound = f"({x}) % {word}"
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        bound = f"list_transform([{bound}], lambda x: xor(x, x >> {shift}) * {factor}::uhugeint % {word})[1]"
    return f"list_transform([{bound}], lambda x: xor(x, x >> 31))[1]"


def run_tables(epochs: int = RUN_EPOCHS, masks: bool = False) -> str:
    inputs = STEP_SIZES[0]
    outputs = STEP_SIZES[-1]
    number = f"(select (count(*) + {ROWS_PER_SHARD - 1}) // {ROWS_PER_SHARD} from chosen)"
    parts = [
        TURN_IDS,
        windows("w", "turn_ids", 1),
        f"""marked as materialized (select doc_id, line_no, k, coalesce(context[1], -1) as ctx, label,
          least(label, {outputs - 1}) as y, {IS_TRAIN} as is_train from w)""",
        "chosen as (select * from marked where is_train)",
        f"""sharded as materialized (select *, cast({md5_int(key('doc_id', 'line_no', 'k'), 17, 15)} % {number} as integer) as shard
          from chosen)""",
        f"""placed as (select *, row_number() over (partition by shard order by doc_id, line_no, k) - 1 as place,
          36 * (select count(*) from chosen) // (100 * {number}) + 1 as batch from sharded)""",
        "batched as materialized (select *, place // batch as batch_no, place % batch as r from placed)",
        "counts as materialized (select shard, batch_no, ctx, y, count(*) as n from batched group by all)",
        "sizes as materialized (select shard, batch_no, sum(n) as n from counts group by all)",
        "tokens_used as (select distinct id as ctx from turn_ids)",
        f"""features as materialized (select ctx, i, {gauss(key('ctx', 'i'))} * 0.1::double
            + {position('0', 'i', inputs)} as x from tokens_used, range({inputs}) r(i)
          union all select -1, i, 0.0::double from range({inputs}) r(i))""",
    ]
    for layer, (fan_in, fan_out) in enumerate(zip(STEP_SIZES, STEP_SIZES[1:])):
        weight = f"{gauss(key(str(layer), 'i', 'j'))} * sqrt(2.0::double / {fan_in + fan_out})"
        parts.append(f"""m0_{layer} as materialized (select i, j, {weight} as w from range({fan_in}) a(i), range({fan_out}) b(j)
          union all select -1, j, 0.0::double from range({fan_out}) b(j))""")
    for epoch in range(1, epochs + 1):
        rate = f"(0.005::double * pow(0.9::double, {epoch - 1}))"
        for layer in range(3):
            parts.append(f"""p{epoch}_0_{layer} as (select shard, i, j, w, 0.0::double as m, 0.0::double as v
              from (select distinct shard from sizes) cross join m{epoch - 1}_{layer})""")
        for step in range(RUN_STEPS):
            parts += run_step(f"{epoch}_{step}", f"{epoch}_{step + 1}", step, rate, epoch if masks else None)
        for layer in range(3):
            after = " union all ".join(
                f"select i, j, w from p{epoch}_{step + 1}_{layer} join sizes using (shard) where batch_no = {step}"
                for step in range(RUN_STEPS)
            )
            parts.append(f"m{epoch}_{layer} as materialized (select i, j, avg(w) as w from ({after}) group by all)")
    return ",\n".join(parts)


def masked_gradient(now: str, step: int, epoch: int) -> list[str]:
    """g{now}_*: the gradients row by row, the outputs of hidden units scaled or dropped by their masks."""
    folded = "0::uhugeint"
    for part in (str(SEED), str(epoch), "shard", str(step)):
        folded = mixed(f"{folded} * {GOLDEN}::uhugeint + {part}::uhugeint + 1")
    parts = [
        f"k{now} as materialized (select shard, {folded} as start from (select distinct shard from sizes))",
        f"""y{now}_0 as materialized (select shard, r, i, x from batched join features using (ctx) where batch_no = {step}
          union all select shard, r, -1, 1.0::double from batched where batch_no = {step})""",
    ]
    for layer in range(3):
        total = f"""select a.shard, a.r, w.j as i, sum(a.x * w.w) as x from y{now}_{layer} a
          join p{now}_{layer} w on w.shard = a.shard and w.i = a.i group by all"""
        if layer < 2:
            drawn = mixed(f"start + (r::uhugeint * {1 << 20} + i::uhugeint + {layer << 56}::uhugeint) * {GOLDEN}::uhugeint")
            total = f"""select shard, r, i, greatest(x, 0) * case when {drawn} >> 40 >= {DROPPED} then 1.25::double else 0 end as x
              from ({total}) join k{now} using (shard)
              union all select shard, r, -1, 1.0::double from batched where batch_no = {step}"""
        parts.append(f"y{now}_{layer + 1} as materialized ({total})")
    parts.append(f"""d{now}_3 as materialized (select t.shard, t.r, t.i as j,
      (exp(x - top) / sum(exp(x - top)) over (partition by t.shard, t.r) - cast(b.y = t.i as integer)) / s.n as d
      from (select *, max(x) over (partition by shard, r) as top from y{now}_3) t
      join batched b on b.shard = t.shard and b.r = t.r and b.batch_no = {step} and b.ctx >= 0
      join sizes s on s.shard = t.shard and s.batch_no = {step})""")
    for layer in (2, 1, 0):
        parts.append(f"""g{now}_{layer} as materialized (select shard, a.i, d.j, sum(a.x * d.d) as g
          from d{now}_{layer + 1} d join y{now}_{layer} a using (shard, r) group by all)""")
        if layer:
            # A kept unit passes its gradient on scaled as its output was.
            parts.append(f"""d{now}_{layer} as materialized (select d.shard, d.r, w.i as j, sum(d.d * w.w) * 1.25::double as d
              from d{now}_{layer + 1} d join p{now}_{layer} w on w.shard = d.shard and w.j = d.j
              join y{now}_{layer} a on a.shard = d.shard and a.r = d.r and a.i = w.i where w.i >= 0 and a.x > 0 group by all)""")
    return parts


def plain_gradient(now: str, a: str) -> list[str]:
    """g{now}_*: the gradients by context, whose features decide alone."""
    parts = [
        f"""d{now}_3 as materialized (select g.shard, g.ctx, p.i as j, (g.n * p.p - coalesce(c.n, 0)) / g.size as d
          from (select shard, ctx, sum(n) as n, any_value(size) as size from f{now} group by all) g
          join {a}_p p on p.shard = g.shard and p.ctx = g.ctx
          left join f{now} c on c.shard = g.shard and c.ctx = g.ctx and c.y = p.i)""",
    ]
    for layer in (2, 1, 0):
        parts.append(f"""g{now}_{layer} as materialized (select shard, a.i, d.j, sum(a.x * d.d) as g
          from d{now}_{layer + 1} d join {a}{layer} a using (shard, ctx) group by all)""")
        if layer:
            parts.append(f"""d{now}_{layer} as materialized (select d.shard, d.ctx, w.i as j, sum(d.d * w.w) as d
              from d{now}_{layer + 1} d join p{now}_{layer} w on w.shard = d.shard and w.j = d.j
              join {a}{layer} a on a.shard = d.shard and a.ctx = d.ctx and a.i = w.i where w.i >= 0 and a.x > 0 group by all)""")
    return parts


def run_step(now: str, then: str, step: int, rate: str, masked_epoch: int | None) -> list[str]:
    """The batch `step` of every shard that has one: from the parameters p{now} to p{then}."""
    a, weights = f"a{now}_", [f"p{now}_{layer}" for layer in range(3)]
    parts = [
        f"c{now} as materialized (select shard, ctx, y, n from counts where batch_no = {step})",
        step_forward(a, f"(select distinct shard, ctx from c{now})", weights, "shard"),
        # Partial windows are counted in the size, and neither learn nor cost.
        f"""f{now} as materialized (select c.shard, ctx, y, c.n, s.n as size from c{now} c join sizes s using (shard)
          where s.batch_no = {step} and ctx >= 0)""",
        f"""l{now} as (select c.shard, sum(c.n * p.nll) / any_value(size) as loss from f{now} c
          join {a}_p p on p.shard = c.shard and p.ctx = c.ctx and p.i = c.y group by c.shard)""",
    ]
    parts += plain_gradient(now, a) if masked_epoch is None else masked_gradient(now, step, masked_epoch)
    for layer in range(3):
        parts.append(f"""p{then}_{layer} as materialized (
          select shard, i, j, case when has then w - {rate} / (1 - pow(0.9::double, {step + 1})) * m2
              / (sqrt(v2 / (1 - pow(0.999::double, {step + 1}))) + 1e-8::double) else w end as w,
            case when has then m2 else m end as m, case when has then v2 else v end as v
          from (select *, 0.9::double * m + (1 - 0.9::double) * g as m2, 0.999::double * v + (1 - 0.999::double) * g * g as v2 from (
            select p.*, coalesce(g, 0) as g, s.n is not null as has from p{now}_{layer} p left join g{now}_{layer} using (shard, i, j)
            left join sizes s on s.shard = p.shard and s.batch_no = {step})))""")
    b = f"b{now}_"
    parts.append(step_forward(b, f"(select distinct shard, ctx from c{now})", [f"p{then}_{layer}" for layer in range(3)], "shard"))
    parts.append(f"""h{now} as (select c.shard, sum(case when y = prediction then n else 0 end) as correct
      from c{now} c join {b}_best b on b.shard = c.shard and b.ctx = c.ctx group by c.shard)""")
    return parts


RUN_LOG = "log as materialized (" + " union all ".join(
    f"""select {epoch} as epoch, s.shard, {step} as batch_no, coalesce(loss, 0) as loss, correct, s.n as total
    from sizes s left join l{epoch}_{step} using (shard) left join h{epoch}_{step} using (shard) where s.batch_no = {step}"""
    for epoch in range(1, RUN_EPOCHS + 1)
    for step in range(RUN_STEPS)
) + ")"


def run_blocks(epoch: int = RUN_EPOCHS) -> str:
    rows = []
    for layer, fan_out in enumerate(STEP_SIZES[1:]):
        rows.append(f"select {layer} as layer, 'weight' as name, i * {fan_out} + j as place, w from m{epoch}_{layer} where i >= 0")
        rows.append(f"select {layer}, 'bias', j as place, w from m{epoch}_{layer} where i = -1")
    return " union all ".join(rows)


RUN_STEPWISE = f"with {run_tables()}"

ORACLES |= {
    "run_model": f"""{RUN_STEPWISE}, blocks as ({run_blocks()})
        select {RUN_EPOCHS} as epoch, layer, name, cast(place // 64 as integer) as block_id, cast(count(*) as integer) as n,
          string_agg(cast({micro('w')} as varchar), ' ' order by place) as "values" from blocks group by all""",
    "run_batches": f"""{RUN_STEPWISE}, {RUN_LOG}
        select cast(epoch as integer) as epoch, shard, cast(batch_no as bigint) as batch_no, {micro('loss')} as loss,
          cast(correct as bigint) as correct, cast(total as bigint) as total from log""",
    "run_metrics": f"""{RUN_STEPWISE}, {RUN_LOG}
        select cast(epoch as integer) as epoch, round(0.005::double * pow(0.9::double, epoch - 1), 6) as learning_rate,
          round(avg(loss), 4) as avg_loss, round(sum(correct) / sum(total)::double * 100, 2) as accuracy_pct, count(*) as batches,
          cast(sum(total) as bigint) as predictions, cast(count(distinct shard) as integer) as shards, count(*) as snapshots,
          (select count(*) from chosen where k = 0) as lines,
          (select count(*) from chosen where label >= {STEP_SIZES[-1] - 1}) as out_of_range from log group by epoch""",
    "run_validation": f"""{RUN_STEPWISE}, held as (select distinct ctx from marked where not is_train),
        {step_forward('v1_', 'held', ['m1_0', 'm1_1', 'm1_2'])}, {step_forward('v2_', 'held', ['m2_0', 'm2_1', 'm2_2'])},
        first as ({class_scores('select y as label, prediction from marked join v1__best using (ctx) where not is_train', nested=True)}),
        second as ({class_scores('select y as label, prediction from marked join v2__best using (ctx) where not is_train', nested=True)})
        select 1 as epoch, * from first union all select 2, * from second""",
}

ORACLES |= {
    "three_way_split": f"""with {DOCS}, placed as (select doc_id, line_no, {md5_int(key('doc_id'), 1)} as place from doc_lines)
        select doc_id, line_no, cast(place >= {int(0.7 * 2**32)} as integer) + cast(place >= {int(0.9 * 2**32)} as integer) as part
        from placed""",
    "text_round_trip": f"with {DOCS} select doc_id, line_no, line from doc_lines",
    "run_table": f"""with {DOCS}, {TURNS}, counted as (
          select 'documents' as run_id, {words('line')} as w from doc_lines
          union all select 'conversations', {words('line')} from turn_lines)
        select run_id, count(*) as lines, cast(sum(len(w)) as bigint) as words from counted group by 1""",
    "metrics_file": f"""select cast(epoch as varchar) as epoch, printf('%.6f', learning_rate) as learning_rate,
          printf('%.4f', avg_loss) as avg_loss, printf('%.2f', accuracy_pct) as accuracy_pct,
          {', '.join(f'cast({c} as varchar) as {c}' for c in ('batches', 'predictions', 'shards', 'snapshots', 'lines', 'out_of_range'))}
        from ({STEP_ORACLES['step_metrics']})""",
    "generated_file": f"""select line as output from (select unnest(string_split(output, chr(10))) as line
        from ({STEP_ORACLES['step_generate']}))""",
}

DROP_LOG = "log as materialized (" + " union all ".join(
    f"""select s.shard, {step} as batch_no, coalesce(loss, 0) as loss, correct, s.n as total
    from sizes s left join l1_{step} using (shard) left join h1_{step} using (shard) where s.batch_no = {step}"""
    for step in range(RUN_STEPS)
) + ")"

ORACLES |= {
    "drop_model": f"""with {run_tables(1, True)}, blocks as ({run_blocks(1)})
        select 1 as epoch, layer, name, cast(place // 64 as integer) as block_id, cast(count(*) as integer) as n,
          string_agg(cast({micro('w')} as varchar), ' ' order by place) as "values" from blocks group by all""",
    "drop_batches": f"""with {run_tables(1, True)}, {DROP_LOG}
        select 1 as epoch, shard, cast(batch_no as bigint) as batch_no, {micro('loss')} as loss,
          cast(correct as bigint) as correct, cast(total as bigint) as total from log""",
    "partition_count_by_key": f"""with {DOCS} select count(distinct doc_id % 7) as partitions, count(*) as rows from doc_lines""",
}
