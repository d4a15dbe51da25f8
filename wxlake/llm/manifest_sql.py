"""SQL twin of the manifest: one common table for each level of the trees."""

from __future__ import annotations

#: Levels written out: trees of up to 8 ** 8 rows, and up to 8 ** 3 trees.
ROW_LEVELS, TREE_LEVELS = 8, 3


def _field(value: str) -> str:
    return f"case when {value} is null then '-' else strlen({value}::varchar) || ':' || {value}::varchar end"


def _levels(name: str, count: int) -> str:
    """``{name}0`` has tree, pos, digest; each next one the runs of eight, or the same node where it is alone."""
    out = []
    for i in range(count):
        out.append(f"""{name}_runs{i} as materialized (
    select tree, pos // 8 as pos, list(digest order by pos) as digests, any_value(size) as size
    from (select *, count(*) over (partition by tree) as size from {name}{i}) group by tree, pos // 8),
{name}{i + 1} as materialized (
    select tree, pos, case when size = 1 then digests[1] else sha256(array_to_string(digests, '')) end as digest from {name}_runs{i})""")
    return ",\n".join(out)


def _climb(rows: str, runs: str, count: int, tree: str, pos: str) -> str:
    """Follow the proof and the folded digest of ``{rows}0`` through the levels of ``runs``."""
    out = []
    for i in range(count):
        place = f"(c.{pos} // {8 ** i})"
        out.append(f"""{rows}{i + 1} as materialized (
    select * exclude (proof, folded, size, before, after), case when size = 1 then proof else proof || before || after end as proof,
           case when size = 1 then folded else sha256(before || folded || after) end as folded
    from (select c.*, size, array_to_string(digests[1:{place} % 8], '') as before, array_to_string(digests[{place} % 8 + 2:], '') as after
          from {rows}{i} as c join {runs}_runs{i} as r on r.tree = c.{tree} and r.pos = {place} // 8))""")
    return ",\n".join(out)


CRC32 = """xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
    lambda a, b: list_reduce(list_concat([xor(a, b)], [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295)"""
LEAF = "sha256(" + " || ".join(_field(f) for f in ("doc_id", "source", "lang", "n_chars", "text")) + ")"
LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

PROVE = f"""
with docs as materialized (
    select doc_id, source, lang, n_chars, text, coalesce('=' || lang, '') as tree, {LEAF} as leaf,
           coalesce({CRC32} % 3 = 0, false) as changed from documents),
leaves as materialized (
    select doc_id, tree, leaf, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos,
           (select {LEAF} from (select docs.doc_id, docs.source, docs.lang, docs.n_chars,
                    case when docs.changed then {LOWERED.replace('text', 'docs.text', 1)} else docs.text end as text)) as given from docs),
n0 as materialized (select tree, pos, leaf as digest from leaves),
{_levels("n", ROW_LEVELS)},
t0 as materialized (select '' as tree, row_number() over (order by tree) - 1 as pos, digest, tree as of_tree from n{ROW_LEVELS}),
{_levels("t", TREE_LEVELS)},
c0 as materialized (select doc_id, leaf, tree, pos, '' as proof, given as folded from leaves),
{_climb("c", "n", ROW_LEVELS, "tree", "pos")},
d0 as materialized (
    select doc_id, leaf, t0.digest as subroot, t0.tree as top, t0.pos as top_pos, proof, folded
    from c{ROW_LEVELS} as c join t0 on t0.of_tree = c.tree),
{_climb("d", "t", TREE_LEVELS, "top", "top_pos")}
select doc_id, leaf, subroot, t{TREE_LEVELS}.digest as root, sha256(proof) as proof_sha256, folded as folded_root,
       folded = t{TREE_LEVELS}.digest as verified
from d{TREE_LEVELS} cross join t{TREE_LEVELS}"""
