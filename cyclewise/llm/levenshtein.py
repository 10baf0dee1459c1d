"""Levenshtein automata intersected with a lexicon trie."""

from __future__ import annotations

from dataclasses import dataclass, field


WORD, STEM, OPEN_STEM = 0, 1, 2


def edits_allowed(length: int) -> int:
    """Misspellings that a term of so many letters tolerates."""
    return 0 if length < 5 else 1 if length < 10 else 2


@dataclass
class LexiconAutomaton:
    """Finds the lexicon terms within their edit distance of a word.

    ``terms``: (letters, kind): a whole word (:data:`WORD`), a stem that any word may begin with (:data:`STEM`), or one
    that needs more letters after it (:data:`OPEN_STEM`).  The automaton reads a word letter
    by letter; its states are sets of (trie node, edits so far), made when first reached and kept.
    """

    terms: list[tuple[str, int]]
    children: list[dict[str, int]] = field(default_factory=lambda: [{}])
    ends: list[list[int]] = field(default_factory=lambda: [[]])
    slack: list[int] = field(default_factory=lambda: [0])

    def __post_init__(self):
        for t, (term, _) in enumerate(self.terms):
            node, most = 0, edits_allowed(len(term))
            self.slack[0] = max(self.slack[0], most)
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.slack.append(0)
                node = self.children[node][c]
                self.slack[node] = max(self.slack[node], most)
            self.ends[node].append(t)
        self._ids: dict[frozenset, int] = {}
        self._sets: list[dict[int, int]] = []
        self._word: list[tuple[int, int] | None] = []
        self._stem: list[tuple[int, int] | None] = []
        self._open: list[tuple[int, int] | None] = []
        self._next: list[dict[str, int]] = []
        self._state({})  # state 0: no term can follow
        self._start = self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        """``nodes``: trie node -> fewest edits; closed under letters that the word leaves out."""
        todo = list(nodes)
        while todo:
            node = todo.pop()
            for child in self.children[node].values():
                e = nodes[node] + 1
                if e <= self.slack[child] and e < nodes.get(child, 99):
                    nodes[child] = e
                    todo.append(child)
        key = frozenset(nodes.items())
        if key not in self._ids:
            self._ids[key] = len(self._sets)
            self._sets.append(nodes)
            self._next.append({})
            for best, kind in ((self._word, WORD), (self._stem, STEM), (self._open, OPEN_STEM)):
                found = [(e, t) for node, e in nodes.items() for t in self.ends[node]
                         if self.terms[t][1] == kind and e <= edits_allowed(len(self.terms[t][0]))]
                best.append(min(found, default=None))
        return self._ids[key]

    def _step(self, state: int, c: str) -> int:
        out: dict[int, int] = {}
        for node, e in self._sets[state].items():
            if e + 1 <= self.slack[node]:
                out[node] = min(out.get(node, 99), e + 1)  # a letter too many
            for letter, child in self.children[node].items():
                cost = e + (letter != c)
                if cost <= self.slack[child]:
                    out[child] = min(out.get(child, 99), cost)
        return self._state(out)

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, term) of the best match, or None."""
        state, best = self._start, None
        for c in word:
            opened = self._open[state]
            if opened is not None and (best is None or opened < best):
                best = opened
            after = self._next[state].get(c)
            if after is None:
                after = self._next[state][c] = self._step(state, c)
            state = after
            stem = self._stem[state]
            if stem is not None and (best is None or stem < best):
                best = stem
            if not state:
                return best
        whole = self._word[state]
        return whole if whole is not None and (best is None or whole < best) else best
