"""A lexicon trie intersected with Levenshtein automata, as one transition table over letter classes.

A state is a set of (trie node, edits so far). Following a word's letters through the table tells which
lexicon term it is within its allowed number of edits of, without comparing it to any term. The table is
built once from the lexicon; its size depends on the lexicon alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: shortest term that may be misspelled by one edit; shorter ones only match as they are
FUZZY_FROM = 5
LAST_CODE_POINT = 0x110000


@dataclass
class TermAutomaton:
    terms: list[str]
    classes: np.ndarray  # code point -> letter class; 0: not in a word, 1: a letter of no term
    table: np.ndarray  # state, class -> state; state 0 accepts nothing any more, state 1 is the start
    term: np.ndarray  # state -> accepted term, or -1
    edits: np.ndarray  # state -> edits of that term

    def match(self, letters: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the matching words, their terms and their edits; ``letters`` are classes of a block."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        word, state, at = np.arange(len(starts)), np.ones(len(starts), dtype=np.int32), starts.copy()
        while len(word):
            done = at >= ends[word]
            hit = done & (self.term[state] >= 0)
            found.append((word[hit], state[hit]))
            word, state, at = word[~done], state[~done], at[~done]
            state = self.table[state, letters[at]]
            alive = state > 0
            word, state, at = word[alive], state[alive], at[alive] + 1
        words, states = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int), np.zeros(0, int))
        order = np.argsort(words, kind="stable")
        return words[order], self.term[states[order]], self.edits[states[order]]


def build(terms: list[str]) -> TermAutomaton:
    """The automaton of distinct, non-empty terms, each within one edit if it has ``FUZZY_FROM`` letters."""
    terms = sorted(set(terms) - {""})
    letters = sorted(set("".join(terms)))
    classes = np.ones(LAST_CODE_POINT, dtype=np.uint8 if len(letters) < 250 else np.uint16)
    code = np.arange(128)
    classes[:128] = ((code >= 48) & (code <= 57)) | ((code >= 65) & (code <= 90)) | ((code >= 97) & (code <= 122))
    for k, letter in enumerate(letters):
        classes[ord(letter)] = k + 2

    children: list[dict[int, int]] = [{}]
    ends: dict[int, int] = {}
    fuzzy = [False]  # whether a term that may be misspelled ends below
    for number, term in enumerate(terms):
        node = 0
        fuzzy[0] |= len(term) >= FUZZY_FROM
        for letter in term:
            symbol = int(classes[ord(letter)])
            if symbol not in children[node]:
                children.append({})
                fuzzy.append(False)
                children[node][symbol] = len(children) - 1
            node = children[node][symbol]
            fuzzy[node] |= len(term) >= FUZZY_FROM
        ends[node] = number

    def closed(state: dict[int, int]) -> frozenset[tuple[int, int]]:
        """With missing letters of the word added: an edit moves on without reading."""
        out = dict(state)
        for node, edits in state.items():
            if edits == 0:
                for child in children[node].values():
                    if fuzzy[child]:
                        out.setdefault(child, 1)
        return frozenset(out.items())

    def step(state: frozenset[tuple[int, int]], symbol: int) -> frozenset[tuple[int, int]]:
        out: dict[int, int] = {}
        for node, edits in state:
            child = children[node].get(symbol)
            if child is not None:
                out[child] = min(edits, out.get(child, 2))
            if edits == 0 and fuzzy[node]:
                out.setdefault(node, 1)  # a letter too many
                for other in children[node].values():
                    if fuzzy[other]:
                        out.setdefault(other, 1)  # a wrong letter
        return closed(out)

    def accepted(state: frozenset[tuple[int, int]]) -> tuple[int, int]:
        best = min(((edits, ends[node]) for node, edits in state if node in ends and (edits == 0 or len(terms[ends[node]]) >= FUZZY_FROM)), default=(0, -1))
        return best[1], best[0]

    start = closed({0: 0})
    numbers, waiting, rows = {frozenset(): 0, start: 1}, [frozenset(), start], []
    for state in waiting:  # grows while states are found
        row = np.zeros(len(letters) + 2, dtype=np.int32)
        for symbol in range(1, len(letters) + 2):
            after = step(state, symbol) if state else state
            if after not in numbers:
                numbers[after] = len(numbers)
                waiting.append(after)
            row[symbol] = numbers[after]
        rows.append(row)
    finals = [accepted(state) for state in waiting]
    return TermAutomaton(terms, classes, np.array(rows), np.array([f[0] for f in finals]), np.array([f[1] for f in finals]))
