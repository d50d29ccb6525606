"""Words of Latin-1 texts by the standard library's pattern, and the search without steps back."""

import random

import pyarrow as pa

from paystrata.llm import bpe
from paystrata.llm.queries import vocabulary
from tests.llm.brute import sha


def test_latin_words_are_the_words_of_the_full_pattern():
    signs = [chr(c) for c in range(256)]
    pairs = [a + b for a in signs for b in signs]
    draw = random.Random(5)
    pairs += ["".join(draw.choices(signs, k=40)) for _ in range(500)]
    pairs += ["".join(draw.choices(" \n\t'sterllvdm1é½ .", k=60)) for _ in range(500)]
    for text in pairs:
        assert bpe.LATIN_WORD.findall(text) == bpe.PLAIN_WORD.findall(text)


def test_longest_arcs_give_the_path_with_steps_back():
    machine, draw = bpe.Automaton(vocabulary()), random.Random(7)
    words = ["".join(draw.choices(" abcdehinorstuéèç0123'-._", k=draw.randint(1, 30))) for _ in range(3000)]
    words += ["你好", "\U0001f600" * 3, " " + "a" * 200]
    for word in words:
        spelled = word.encode()
        assert machine.path(spelled) == machine._path_with_steps_back(spelled)


def by_merges(machine, word):
    """The tokens of a word by its merges, the least rank first and of equal ones the leftmost."""
    tokens = [machine.token[word[n : n + 1]] for n in range(len(word))]
    while True:
        pairs = [(machine.merge_rank.get(p, bpe.NEVER), n) for n, p in enumerate(zip(tokens, tokens[1:]))]
        rank, at = min(pairs, default=(bpe.NEVER, 0))
        if rank == bpe.NEVER:
            return tokens
        made = machine.label[tokens[at]] + machine.label[tokens[at + 1]]
        tokens[at : at + 2] = [machine.token[made]]


def test_paths_are_what_the_merges_make():
    machine, draw = bpe.Automaton(vocabulary()), random.Random(11)
    words = ["".join(draw.choices(" abcdehinorstuéèç0123'-._\n", k=draw.randint(1, 40))) for _ in range(2000)]
    words += ["".join(draw.choices(["th", "er", "tion", " an", "le", "st", "ed", "ou"], k=8)) for _ in range(2000)]
    words += ["你好 😀", " " + "a" * 300, "=" * 100]
    for word in words:
        assert machine.path(word.encode()) == by_merges(machine, word.encode())


def test_words_in_use_stay_remembered(monkeypatch):
    monkeypatch.setattr(bpe, "WORD_MEMORY", 20)
    machine, searched = bpe.Automaton(vocabulary()), []
    plain = machine.path
    monkeypatch.setattr(machine, "path", lambda word: searched.append(word) or plain(word))
    text = "".join(f" the a{chr(97 + n // 26)}{chr(97 + n % 26)}" for n in range(200))
    ids = machine.encode(text)
    assert searched.count(b" the") == 1 and len(machine.words) + len(machine.older_words) <= 20
    assert machine.decode(ids) == text


def test_decoded_text_is_read_from_the_ids():
    """A label that is changed shows in the text, so the text is not that which came in."""
    machine = bpe.Automaton(vocabulary())
    machine.label[machine.token[b" the"]] = b" THE"
    ids, decoded = machine.encode_and_spell("of the cat <|endoftext|>")
    assert decoded == machine.decode(ids.tolist()) == "of THE cat <|endoftext|>"


def test_digest_is_of_the_text_decoded_from_the_ids(monkeypatch):
    machine = bpe.Automaton(vocabulary())
    machine.label[machine.token[b" the"]] = b" THE"
    monkeypatch.setattr(bpe, "automaton", lambda path: machine)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["of the cat", None]})
    found = next(bpe._digests("any")(iter([batch]))).to_pydict()
    ids = machine.encode("of the cat")
    assert found["n_tokens"] == [len(ids), 0]
    assert found["ids_sha256"] == [sha(",".join(map(str, ids))), sha("")]
    assert found["decoded_sha256"] == [sha("of THE cat"), sha("")]


def test_encode_gives_the_text_decoded_from_the_ids(monkeypatch):
    """As the pipeline's last stage takes it."""
    machine = bpe.Automaton(vocabulary())
    machine.label[machine.token[b" the"]] = b" THE"
    monkeypatch.setattr(bpe, "automaton", lambda path: machine)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["of the cat", None]})
    found = next(bpe._tokens("any")(iter([batch]))).to_pydict()
    assert found["ids"] == [machine.encode("of the cat"), []]
    assert found["decoded"] == ["of THE cat", ""]
