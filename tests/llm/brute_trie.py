"""The trie contract in plain Python."""
import hashlib
import zlib
from collections import defaultdict


def own_turns(rows):
    """Turns of each conversation in order; ties in an order of their own."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for *_, r, t in sorted(v)] for c, v in convs.items()}


def remainder(c):
    return abs(c) % 100 * (1 if c >= 0 else -1)


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - remainder(c), [])[:h] + turns[h:]
    return out


def nodes_of(convs):
    nodes = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for n in nodes:
        if n:
            children[n[:-1]].append(n)
    leaves, saved = {}, {}
    for n in sorted(nodes, key=len, reverse=True):
        leaves[n] = sum(leaves[k] for k in children[n]) or 1
        saved[n] = (len(nodes[n]) - 1) * (len(n[-1][1]) if n else 0) + sum(saved[k] for k in children[n])
    out = []
    for n, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in members if len(convs[c]) == len(n)))
        out.append((min(members), len(n), min(nodes[n[:-1]]) if n else None, len(members), len(children[n]), leaves[n], saved[n],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return out


def brute(rows):
    return nodes_of(rebuilt(own_turns(rows)))
