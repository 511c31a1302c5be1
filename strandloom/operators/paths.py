"""Paths through one component's graph: nodes, reads and mates on them, circles unrolled, transcripts.

A component's edges and reads are one group; groups are independent, so each is one pandas call. Within it k-mers that lie in a row without branches are
one node, so work follows branches and reads, not letters. How many paths a node may hand to each next one is bounded by ``most_paths`` (W01), as surveyed.

A fragment on the graph is a pair of node paths, (first, second); second is empty where one path tells it all.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.operators.align import align, too_similar


class Graph:
    """Nodes of one component: runs of k-mers without branches, numbered in the order of their first k-mers. ``letters`` of a node are those that it adds behind a node before
    it; a node that begins a path also has the k - 1 letters in front of them."""

    def __init__(self, edges: list[tuple[str, str]], k: int):
        self.k = k
        after: dict[str, list[str]] = defaultdict(list)
        into: Counter = Counter()
        for a, b in sorted(set(edges)):
            after[a].append(b)
            into[b] += 1
        kmers = sorted({x for e in edges for x in e})
        inner = {b for a in kmers for b in after.get(a, []) if len(after[a]) == 1 and into[b] == 1 and a != b}
        runs, seen = [], set()
        for start in [x for x in kmers if x not in inner] + kmers:  # what is left after the first are circles without branches
            if start in seen:
                continue
            run = [start]
            seen.add(start)
            while len(step := after.get(run[-1], [])) == 1 and step[0] in inner and step[0] not in seen:
                run.append(step[0])
                seen.add(step[0])
            runs.append(run)
        runs.sort()
        self.runs = runs
        self.place = {x: (n, i) for n, run in enumerate(runs) for i, x in enumerate(run)}
        self.head = {n: run[0][:-1] for n, run in enumerate(runs)}
        self.letters = {n: "".join(x[-1] for x in run) for n, run in enumerate(runs)}
        self.after: dict[int, set[int]] = {n: {self.place[b][0] for b in after.get(run[-1], [])} for n, run in enumerate(runs)}
        self.kmers_after = after

    def sequence(self, path: list[int]) -> str:
        return self.head[path[0]] + "".join(self.letters[n] for n in path) if path else ""

    def copy_of(self, node: int) -> int:
        new = max(self.letters) + 1
        self.head[new], self.letters[new], self.after[new] = self.head[node], self.letters[node], set()
        return new

    def before(self) -> dict[int, set[int]]:
        out: dict[int, set[int]] = {n: set() for n in self.after}
        for a, bs in self.after.items():
            for b in bs:
                out[b].add(a)
        return out

    def reachable(self) -> dict[int, set[int]]:
        """All nodes behind each node."""
        out: dict[int, set[int]] = {}
        for n in self.after:
            todo, found = list(self.after[n]), set()
            while todo:
                x = todo.pop()
                if x not in found:
                    found.add(x)
                    todo += self.after[x]
            out[n] = found
        return out


def thread_read(seq: str, k: int, after: dict[str, list[str]], most_mismatches: int = 5) -> list[str]:
    """The path of k-mers along which a read fits best (P17): it starts at the read's first k-mer that is a node, and follows edges with the fewest
    mismatches, at most so many; among equals the longer path, then the one with the smaller letters. Empty if no k-mer is a node. Of the ways to a k-mer only the
    best goes on, so time follows the read's length and the k-mers met, not the number of ways."""
    start = next((i for i in range(len(seq) - k + 1) if seq[i : i + k] in after), None)
    if start is None:
        return []
    first = seq[start : start + k]
    now: dict[str, tuple[int, tuple]] = {first: (0, (None, first))}  # k-mer -> mismatches, way to it as (way before, k-mer)
    ended: list[tuple[int, int, tuple]] = []
    for at in range(start + k, len(seq)):
        new: dict[str, tuple[int, tuple]] = {}
        for kmer in sorted(now):  # of equal ways to a k-mer the one over the smaller k-mer before it
            bad, way = now[kmer]
            steps = after.get(kmer, [])
            if not steps:
                ended.append((bad, at, way))
            for n in steps:
                worse = bad + (n[-1] != seq[at])
                if worse <= most_mismatches and (n not in new or worse < new[n][0]):
                    new[n] = (worse, (way, n))
        if not new:
            break
        now = new
    else:
        ended += [(bad, len(seq), way) for _, (bad, way) in sorted(now.items())]
    best: list[str] | None = None
    rank = None
    for bad, at, way in ended:
        if rank and (bad, -at) > rank:
            continue
        path = []
        while way:
            way, kmer = way
            path.append(kmer)
        path.reverse()
        if rank is None or (bad, -at) < rank or path < best:
            rank, best = (bad, -at), path
    return best or []


def sequence_of(kmers: list[str]) -> str:
    """The letters of a path of k-mers."""
    return kmers[0] + "".join(x[-1] for x in kmers[1:]) if kmers else ""


def node_path(kmers: list[str], graph: Graph) -> tuple[int, ...]:
    """A path of k-mers as one of nodes; a node is named again where it is entered again."""
    out: list[int] = []
    last = -1
    for x in kmers:
        n, i = graph.place[x]
        if not out or n != out[-1] or i <= last:
            out.append(n)
        last = i
    return tuple(out)


def contains(path: tuple, part: tuple) -> bool:
    """Whether ``part`` stands in a row in ``path``."""
    return any(tuple(path[i : i + len(part)]) == tuple(part) for i in range(len(path) - len(part) + 1))


def combine_mates(a: tuple, b: tuple, behind: dict) -> tuple[tuple, tuple] | None:
    """The pair of paths of two mates (P18): one path where a mate's nodes are all in the other or the two overlap by nodes, else both in the order in which the graph leads from
    one to the other; None if it leads nowhere. behind[x]: all nodes that can follow x."""
    a, b = tuple(a), tuple(b)
    if not a or not b:
        return (a or b, ()) if a or b else None
    if set(b) <= set(a):
        return a, ()
    if set(a) <= set(b):
        return b, ()
    for x, y in ((a, b), (b, a)):
        if y[0] in behind.get(x[-1], ()):
            return x, y
    for x, y in ((a, b), (b, a)):
        if y[0] in x and y[0] in behind.get(x[0], ()):
            return x[: x.index(y[0])] + y, ()
    return None


def compatible(pair: tuple[tuple, tuple], path: tuple) -> bool:
    """Whether a pair's paths and a path agree: they share a node, and where either of the pair's paths meets the path, one of the two begins there and both go on alike until
    one ends."""
    met = False
    for part in pair:
        common = next((x for x in path if x in part), None) if part else None
        if common is None:
            continue
        met = True
        i, j = path.index(common), part.index(common)
        if i and j:
            return False
        if any(x != y for x, y in zip(path[i:], part[j:], strict=False)):
            return False
    return met


def supported(path: tuple, step: int, pairs: list[tuple[tuple, int]], graph_letters: dict, look_back: int, least: int = 2, mode: str = "compatible", enforces=None) -> bool:
    """Whether at least so many fragments support going on from a path to ``step`` (P20). compatible: they hold the step with the nodes before it that cover ``look_back`` letters, and agree
    with the whole path. lenient: they hold the path's last node and the step, and agree with the path. original: each node of that stretch is one that the fragment
    enforces; enforces(pair, node) tells."""
    whole = (*path, step)
    size, first = len(graph_letters[step]), len(path) - 1
    part = [step]
    while first >= 0 and (len(part) == 1 or size < look_back):
        part.insert(0, path[first])
        size += len(graph_letters[path[first]])
        first -= 1
    n = 0
    for pair, count in pairs:
        if mode == "lenient":
            ok = all(any(x in p for p in pair) for x in (path[-1], step)) and compatible(pair, tuple(path))
        elif mode == "original":
            ok = all(enforces(pair, x) for x in part)
        else:
            ok = any(contains(p, tuple(part)) for p in pair) and compatible(pair, whole)
        n += count if ok else 0
        if n >= least:
            return True
    return False


def enforced_by(graph: Graph):
    """enforces(pair, node): the fragment holds the node, or without it no root leads to the fragment's begin, its end to no leaf, or its first path to its second."""
    before = graph.before()
    roots, leaves = [n for n in graph.after if not before[n]], {n for n in graph.after if not graph.after[n]}

    def leads(start: list[int], stop: set[int], without: int) -> bool:
        todo, seen = [n for n in start if n != without], set()
        while todo:
            x = todo.pop()
            if x in stop:
                return True
            if x not in seen:
                seen.add(x)
                todo += [y for y in graph.after[x] if y != without]
        return False

    def enforces(pair: tuple[tuple, tuple], node: int) -> bool:
        first, second = pair
        last = second or first
        if node in first or node in second:
            return True
        return not leads(roots, {first[0]}, node) or not leads([last[-1]], leaves, node) or bool(second) and not leads([first[-1]], {second[0]}, node)

    return enforces


def _laps(path: tuple, node: int, side: int | None) -> list[int]:
    """How often each place of a path has come round to ``node``, from itself or over ``side``; 0 at other places."""
    out, lap = [], 0
    for i, x in enumerate(path):
        before = path[i - 1] if i else None
        if x == node:
            lap = lap + 1 if before == (node if side is None else side) else 0
        elif x == side:
            lap = lap if before == node else 0
        out.append(lap if x in (node, side) else 0)
    return out


def unroll(graph: Graph, fragments: Counter) -> Counter:
    """Circles of one and of two nodes as chains (P13): as many copies of the node (and of the one beside it) as a fragment goes through at most in a row, each with the ways out
    of the first; fragments' paths name the copies. Of two nodes, the one that fragments come round to most is copied, on a tie the one that is entered from elsewhere. The graph changes; the
    new fragments come back. Longer circles are left for ``unroll_longer``."""
    done: set[int] = set()
    for start in sorted(graph.after):
        if start in done:
            continue
        around = sorted(x for x in graph.after[start] if x != start and x not in done and start in graph.after[x] and x not in graph.after[x])
        if start in graph.after[start]:
            choices = [(start, None)]
        elif around:
            choices = [(start, around[0]), (around[0], start)]
        else:
            continue
        before = graph.before()
        count = lambda c, f=fragments: max([0, *(lap for pair in f for p in pair for lap in _laps(p, *c))])
        node, side = max(choices, key=lambda c: (count(c), bool(before[c[0]] - set(c)), -c[0]))
        done |= {node} if side is None else {node, side}
        out = graph.after[node] - {node, side}
        out_side = graph.after[side] - {node} if side is not None else set()
        copies, beside = [node], [side]
        graph.after[node] = set(out)
        if side is not None:
            graph.after[node].add(side)
            graph.after[side] = set(out_side)
        for _ in range(count((node, side))):
            new = graph.copy_of(node)
            done.add(new)
            graph.after[new] = set(out)
            graph.after[copies[-1] if side is None else beside[-1]].add(new)
            copies.append(new)
            if side is not None:
                extra = graph.copy_of(side)
                done.add(extra)
                graph.after[extra] = set(out_side)
                graph.after[new].add(extra)
                beside.append(extra)
        if side is not None and not any(beside[-1] == y for pair in _renamed(fragments, node, side, copies, beside) for p in pair for y in p):
            graph.after[copies[-1]].discard(beside[-1])  # no fragment goes on to the last one beside
            del graph.after[beside[-1]]
        fragments = _renamed(fragments, node, side, copies, beside)
    return fragments


def _renamed(fragments: Counter, node: int, side: int | None, copies: list[int], beside: list[int]) -> Counter:
    out: Counter = Counter()
    for (p, q), n in fragments.items():
        out[tuple(tuple(copies[lap] if x == node else beside[lap] if x == side else x for x, lap in zip(path, _laps(path, node, side), strict=True)) for path in (p, q))] += n
    return out


def strong_parts(after: dict) -> list[list]:
    """Sets of nodes that all lead to each other, those of two and more: what a node leads to and what leads to it, within what is left, have in common its own set."""
    before: dict = {}
    for v, us in after.items():
        for u in us:
            before.setdefault(u, set()).add(v)

    def reached(start, near: dict, among: set) -> set:
        seen, todo = {start}, [start]
        while todo:
            for n in near.get(todo.pop(), ()):
                if n in among and n not in seen:
                    seen.add(n)
                    todo.append(n)
        return seen

    out, todo = [], [set(after) | set(before)]
    while todo:
        among = todo.pop()
        loose = [n for n in among if not (before.get(n, set()) & among) or not (after.get(n, set()) & among)]
        while loose:  # a node without a way in or out is in no circle
            among.difference_update(loose)
            near = {m for n in loose for m in (*after.get(n, ()), *before.get(n, ()))} & among
            loose = [n for n in near if not (before.get(n, set()) & among) or not (after.get(n, set()) & among)]
        if not among:
            continue
        start = min(among)
        ahead, behind = reached(start, after, among), reached(start, before, among)
        if len(part := ahead & behind) > 1:
            out.append(sorted(part))
        todo += [x for x in (ahead - part, behind - part, among - ahead - behind) if x]
    return sorted(out)


def unroll_longer(graph: Graph, fragments: Counter) -> Counter:
    """Circles of three and more nodes as chains (P13). The nodes of a strongly connected part go in an order from where fragments enter it; an edge against the order begins a new
    lap. There is a copy of the part for each lap that a fragment makes at most; edges against the order lead to the next copy, and none leads out of the last one so. Every copy has the part's ways out, and only
    the first its ways in; of the others, what their first nodes lead to stays. The graph changes; the fragments, renamed to the copies, come back."""
    for part in strong_parts(graph.after):
        inside = set(part)
        entered = Counter({n: 0 for n in part})
        for pair, times in fragments.items():
            for p in pair:
                entered.update({b: times for a, b in zip((None, *p), p, strict=False) if b in inside and a is not None and a not in inside})
        ways = {n for v, us in graph.after.items() if v not in inside for n in us & inside}
        head = max(part, key=lambda n, e=entered, w=ways: (e[n], n in w, -n))
        links = {n: graph.after.get(n, set()) & inside for n in part}
        order = {n: i for i, n in enumerate([head, *(n for n in topological({v: us - {head} for v, us in links.items()}) if n != head)])}

        def laps(path, inside=inside, order=order) -> list[int]:
            out, lap, before = [], 0, None
            for x in path:
                if x not in inside:
                    lap, before = 0, None
                elif before is not None and order[x] <= order[before]:
                    lap += 1
                before = x if x in inside else None
                out.append(lap)
            return out

        most = max([0, *(lap for pair in fragments for p in pair for lap in laps(p))])
        copies = [{n: n for n in part}]
        leave = {n: graph.after.get(n, set()) - inside for n in part}
        forward = {n: {u for u in us if order[u] > order[n]} for n, us in links.items()}
        back = {n: us - forward[n] for n, us in links.items()}
        for n in part:
            graph.after[n] = leave[n] | forward[n]
        for _ in range(most):
            starts = {u for n in copies[-1] for u in back[n]}
            seen, todo = set(starts), list(starts)
            while todo:
                for u in forward[todo.pop()] - seen:
                    seen.add(u)
                    todo.append(u)
            new = {n: graph.copy_of(n) for n in sorted(seen)}
            for n, c in new.items():
                graph.after[c] = leave[n] | {new[u] for u in forward[n]}
            for n, c in copies[-1].items():
                graph.after[c] |= {new[u] for u in back[n]}
            copies.append(new)
        renamed: Counter = Counter()
        for pair, times in fragments.items():
            renamed[tuple(tuple(copies[lap][x] if x in inside else x for x, lap in zip(p, laps(p), strict=True)) for p in pair)] += times
        fragments = renamed
    return fragments


def topological(after: dict) -> list:
    """Nodes so that each comes after its predecessors; circles are entered at their smallest node."""
    into = Counter(u for us in after.values() for u in us)
    nodes = set(after) | set(into)
    out, ready = [], sorted(n for n in nodes if not into[n])
    left = set(nodes)
    while left:
        if not ready:
            ready = [min(left)]
        v = ready.pop(0)
        if v not in left:
            continue
        left.discard(v)
        out.append(v)
        for u in sorted(after.get(v, [])):
            into[u] -= 1
            if not into[u] and u in left:
                ready.append(u)
    return out


def without_circles(after: dict, order: list) -> dict:
    """Edges that go forward in the order: one edge of each circle that is left is dropped."""
    place = {n: i for i, n in enumerate(order)}
    return {v: {u for u in us if place[u] > place[v]} for v, us in after.items()}


def enumerate_paths(graph: Graph, order: list[int], fragments: Counter, most_paths: int = 1000, look_back: int = 0, least_support: int = 2, mode: str = "compatible", lock: bool = True) -> list[tuple]:
    """Transcript paths (P19). Nodes go in topological order. Paths that end at a node, the best supported first and at most ``most_paths`` + 1 a next node, are extended where
    the triplets seen in fragments allow it (P21) and fragments support it; a next node that no path reaches gets a new one from here. Paths that nothing extends are transcripts,
    but for those that stand in others as a whole."""
    by_node: dict[int, list] = defaultdict(list)
    locked: dict[int, set] = defaultdict(set)
    for pair, n in sorted(fragments.items()):
        for x in set(pair[0]) | set(pair[1]):
            by_node[x].append((pair, n))
        for p in pair:
            for x, v, y in zip(p, p[1:], p[2:], strict=False):
                locked[v].add((x, y))
    enforces = enforced_by(graph) if mode == "original" else None
    at: dict[int, list[tuple]] = defaultdict(list)
    done: list[tuple] = []
    for v in order:
        paths = at.pop(v, [(v,)])
        weight = {p: sum(n for pair, n in by_node[v] if compatible(pair, p)) for p in paths}
        paths.sort(key=lambda p: (-weight[p], p))
        extended = set()
        for u in sorted(graph.after[v]):
            here = by_node[u] if mode == "original" else [x for x in by_node[u] if any(v in p for p in x[0])]
            found = []
            for p in paths:
                if len(found) > most_paths:
                    break
                if lock and len(p) > 1 and v in locked and (p[-2], u) not in locked[v]:
                    continue
                if supported(p, u, here, graph.letters, look_back, least_support, mode, enforces):
                    found.append((*p, u))
                    extended.add(p)
            new = found or [(v, u)]
            at[u] += [p for p in new if p not in at[u]]
        done += [p for p in paths if p not in extended]
    unique = sorted(set(done), key=lambda p: (-len(p), p))
    out: list[tuple] = []
    for p in unique:
        if not any(contains(q, p) for q in out):
            out.append(p)
    return sorted(out)


def drop_similar(paths: list[tuple], sequence, weight) -> list[tuple]:
    """Of paths with one end in common whose sequences are too similar, the longer one, of equal ones the heavier."""
    kept: list[tuple] = []
    for p in sorted(paths, key=lambda p: (-len(sequence(p)), -weight(p), p)):
        for q in kept:
            if p[0] == q[0] or p[-1] == q[-1]:
                a, b = sequence(p), sequence(q)
                b = b[-len(a) - 10 :] if p[-1] == q[-1] else b[: len(a) + 10]
                r = align(a, b)
                if too_similar(r["gaps"], r["mismatches"], r["matches"]):
                    break
        else:
            kept.append(p)
    return kept


def stretches(path: tuple, graph: Graph) -> str:
    """The nodes of a path with the places of their letters in its sequence (P23): [node:first-last ...], 0-based and inclusive."""
    at, out = 0, []
    for i, n in enumerate(path):
        size = len(graph.letters[n]) + (len(graph.head[n]) if i == 0 else 0)
        out.append(f"{n}:{at}-{at + size - 1}")
        at += size
    return f"[{' '.join(out)}]"


def fragments_of(reads: list[tuple], graph: Graph, most_mismatches: int = 5) -> Counter:
    """How many fragments have each pair of node paths. reads: (sequence, fragment, mate); a null fragment is a read by itself."""
    known: dict[str, tuple[int, ...]] = {}
    mates: dict = defaultdict(list)
    out: Counter = Counter()
    nodes = {x: graph.kmers_after.get(x, []) for x in graph.place}
    for seq, fragment, mate in reads:
        if seq not in known:
            known[seq] = node_path(thread_read(seq, graph.k, nodes, most_mismatches), graph)
        if fragment is None:
            if known[seq]:
                out[known[seq], ()] += 1
        else:
            mates[fragment].append((mate, known[seq]))
    behind = graph.reachable() if mates else {}
    for found in mates.values():
        parts = [p for _, p in sorted(found, key=lambda x: (x[0] is None, x[0], x[1]))]
        pair = combine_mates(*parts, behind) if len(parts) == 2 else None
        if pair:
            out[pair] += 1
        elif len(parts) != 2:
            out.update((p, ()) for p in parts if p)
    return out


def _grouped(edges: DataFrame, reads: DataFrame) -> DataFrame:
    none = lambda t: F.lit(None).cast(t)
    mates = [F.col(c).cast(t).alias(c) if c in reads.columns else none(t).alias(c) for c, t in (("fragment", "string"), ("mate", "int"))]
    both = edges.select("component", "src", "dst", none("string").alias("seq"), none("string").alias("fragment"), none("int").alias("mate"))
    return both.unionByName(reads.select("component", none("string").alias("src"), none("string").alias("dst"), "seq", *mates))


def _read_group(pdf: pd.DataFrame, k: int) -> tuple[Graph, Counter]:
    pdf = pdf.astype(object).where(pdf.notna(), None)
    graph = Graph([(a, b) for a, b in zip(pdf["src"], pdf["dst"], strict=True) if a is not None and b is not None], k)
    return graph, fragments_of([(s, f, m) for s, f, m in zip(pdf["seq"], pdf["fragment"], pdf["mate"], strict=True) if s is not None], graph)


def threaded(edges: DataFrame, reads: DataFrame, k: int) -> DataFrame:
    """(component, first, second, n): the fragments' pairs of node paths (P17, P18). Inputs as of ``transcripts``."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        _, seen = _read_group(pdf, k)
        c = pdf["component"].iat[0]
        return pd.DataFrame([(c, list(p), list(q), n) for (p, q), n in sorted(seen.items())], columns=["component", "first", "second", "n"])

    return _grouped(edges, reads).groupBy("component").applyInPandas(run, "component long, first array<int>, second array<int>, n long")


def transcripts(edges: DataFrame, reads: DataFrame, k: int, least_length: int = 0, most_paths: int = 1000, look_back: int = 0, least_support: int = 2, mode: str = "compatible") -> DataFrame:
    """(component, seq_no, seq, len, path, support) from edges (component, src, dst) and reads (component, seq, and where mates are known fragment and mate).
    support: fragments that agree with a transcript and lie in it."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        graph, seen = _read_group(pdf, k)
        seen = unroll_longer(graph, unroll(graph, seen))
        graph.after = without_circles(graph.after, topological(graph.after))
        order = topological(graph.after)
        weight = lambda p: sum(n for pair, n in seen.items() if compatible(pair, p))
        found = drop_similar(enumerate_paths(graph, order, seen, most_paths, look_back, least_support, mode), graph.sequence, weight)
        rows = []
        for i, p in enumerate(sorted(found, key=lambda p: (-len(graph.sequence(p)), p))):
            s = graph.sequence(p)
            if len(s) >= least_length:
                inside = sum(n for pair, n in seen.items() if all(not part or contains(p, part) for part in pair))
                rows.append((pdf["component"].iat[0], i, s, len(s), stretches(p, graph), inside))
        return pd.DataFrame(rows, columns=["component", "seq_no", "seq", "len", "path", "support"])

    return _grouped(edges, reads).groupBy("component").applyInPandas(run, "component long, seq_no int, seq string, len int, path string, support long")


def headers(found: DataFrame) -> DataFrame:
    """(header, seq) of an output file."""
    return found.select(F.format_string("comp%d_c0_seq%d len=%d path=%s", "component", "seq_no", "len", "path").alias("header"), "seq")


def similar_pairs(paths: DataFrame, most_mismatches: int = 2) -> DataFrame:
    """(node, a, b, mismatches, similar): the pairs of paths at a node, smaller id first (J17), with the mismatches of their sequences laid side by side from the end that they share.
    paths: node, id, seq. Which paths meet at a node is bounded by W01."""
    from strandloom.functions import seq as S

    a = paths.select("node", F.col("id").alias("a"), F.col("seq").alias("_a"))
    b = paths.select("node", F.col("id").alias("b"), F.col("seq").alias("_b"))
    pairs = a.join(b, "node").where("a < b").withColumn("mismatches", S.mismatches(F.reverse("_a"), F.reverse("_b")).cast("long"))
    return pairs.select("node", "a", "b", "mismatches", (F.col("mismatches") <= most_mismatches).alias("similar"))


def share_prefixes(edges: list[tuple[int, int, float]], letters: dict[int, str]) -> tuple[list[tuple[int, int, float]], dict[int, str]]:
    """Edges and letters of a graph in which nodes with the same nodes before them share the first letters that they have in common (P11). Nodes go by depth. Of those
    with equal parents, all that begin with one letter get a new node of that letter in front, whose edges from the parents weigh the largest of theirs and whose edge to what is left
    of each weighs the largest that entered it; the rest goes the same way. A node of which nothing is left hands its edges on to the new one."""
    after: dict[int, dict[int, float]] = defaultdict(dict)
    before: dict[int, dict[int, float]] = defaultdict(dict)
    letters = dict(letters)

    def join(a: int, b: int, w: float) -> None:
        after[a][b] = before[b][a] = max(w, after[a].get(b, w))

    def part(a: int, b: int) -> float:
        before[b].pop(a)
        return after[a].pop(b)

    for a, b, w in edges:
        join(a, b, w)
    order = topological({a: list(bs) for a, bs in after.items()} | {n: list(after.get(n, {})) for n in letters})
    depth = {n: 0 for n in letters}
    for n in order:
        for u in after[n]:
            depth[u] = max(depth.get(u, 0), depth[n] + 1)
    todo = sorted({(d, n) for n, d in depth.items()})
    while todo:
        level = todo[0][0]
        now = [n for d, n in todo if d == level and n in letters]
        todo = [x for x in todo if x[0] != level]
        groups: dict[tuple, list[int]] = defaultdict(list)
        for n in now:
            if before[n] and letters[n]:
                groups[tuple(sorted(before[n])), letters[n][0]].append(n)
        for (parents, letter), members in sorted(groups.items()):
            if len(members) < 2:
                continue
            new = max(letters) + 1
            letters[new] = letter
            for n in members:
                entering = [part(p, n) for p in parents]
                for p, w in zip(parents, entering, strict=True):
                    join(p, new, w)
                letters[n] = letters[n][1:]
                if letters[n]:
                    join(new, n, max(entering))
                    todo.append((level + 1, n))
                else:
                    for u in list(after[n]):
                        join(new, u, part(n, u))
                        todo.append((level + 1, u))
                    del letters[n]
        todo = sorted(set(todo))
    return sorted((a, b, w) for a, bs in after.items() for b, w in bs.items()), letters


def compact_prefixes(edges: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(component, src, dst, w) and (component, node, letters) after ``share_prefixes`` in each component."""
    rows = edges.select("component", "src", "dst", F.col("w").cast("double").alias("w"), F.lit(None).cast("string").alias("letters"))
    rows = rows.unionByName(nodes.select("component", F.col("node").alias("src"), F.lit(None).cast("long").alias("dst"), F.lit(None).cast("double").alias("w"), "letters"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        is_node = pdf["letters"].notna()
        letters = {int(n): x for n, x in zip(pdf["src"][is_node], pdf["letters"][is_node], strict=True)}
        e, letters = share_prefixes([(int(a), int(b), float(w)) for a, b, w in pdf.loc[~is_node, ["src", "dst", "w"]].itertuples(index=False)], letters)
        c = pdf["component"].iat[0]
        out = [(c, a, b, w, None) for a, b, w in e] + [(c, n, None, None, x) for n, x in sorted(letters.items())]
        return pd.DataFrame(out, columns=["component", "src", "dst", "w", "letters"]).astype({"dst": "Int64"})

    done = rows.groupBy("component").applyInPandas(run, "component long, src long, dst long, w double, letters string")
    return done.where("letters IS NULL").select("component", "src", "dst", "w"), done.where("letters IS NOT NULL").select("component", F.col("src").alias("node"), "letters")


def break_by_pairs(sequences: DataFrame, spans: DataFrame, least: int = 1, margin: int = 25) -> DataFrame:
    """(id, part, lend, rend, seq): sequences cut where fewer than ``least`` fragments reach over a place, but for ``margin`` letters at either end (P26). sequences: id, seq;
    spans: id, lend, rend, what each fragment covers from end to end. Places that none covers fall to no part."""
    from strandloom.operators.coverage import depth_runs

    inner = sequences.select(F.col("id").cast("string").alias("scaff"), (F.lit(1) + margin).cast("long").alias("from"), (F.length("seq") - margin).cast("long").alias("to"), F.length("seq").cast("long").alias("n"))
    ends = inner.select("scaff", F.lit(1).cast("long").alias("lend"), F.least(F.col("from") - 1, "n").alias("rend")).unionByName(inner.select("scaff", F.greatest(F.col("to") + 1, F.lit(1)).alias("lend"), F.col("n").alias("rend")))
    weight = F.explode(F.array_repeat(F.lit(1), least))  # ends always count as covered
    covered = spans.select(F.col("id").cast("string").alias("scaff"), F.col("lend").cast("long").alias("lend"), F.col("rend").cast("long").alias("rend")).unionByName(ends.where("lend <= rend").select("scaff", "lend", "rend", weight.alias("_w")).drop("_w"))
    from strandloom.operators.intervals import merge_near

    parts = merge_near(depth_runs(covered).where(F.col("cov") >= least), 0).withColumnRenamed("scaff", "_id")
    rows = parts.join(sequences.withColumn("_id", F.col("id").cast("string")), "_id").where(F.col("lend") <= F.length("seq"))
    from pyspark.sql import Window

    k = F.row_number().over(Window.partitionBy("id").orderBy("lend"))
    return rows.select("id", k.alias("part"), "lend", F.least("rend", F.length("seq")).cast("long").alias("rend"), F.expr("substring(seq, CAST(lend AS INT), CAST(rend - lend + 1 AS INT))").alias("seq"))


def join_by_pairs(links: DataFrame, least: int = 2) -> DataFrame:
    """(a, b, n): the next sequence of each (P26): of the sequences that at least so many fragments lead to from a, the one with most, and only if a is also the one that leads to it
    most; ties go to smaller ids. links: a, b, a row a fragment whose first mate lies in a and whose second lies in b."""
    n = links.where("a != b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    ahead = n.groupBy("a").agg(F.min(F.struct((-F.col("n")).alias("m"), "b"))["b"].alias("b"))
    back = n.groupBy("b").agg(F.min(F.struct((-F.col("n")).alias("m"), "a"))["a"].alias("a"))
    return n.join(ahead, ["a", "b"], "left_semi").join(back, ["a", "b"], "left_semi").select("a", "b", "n")
