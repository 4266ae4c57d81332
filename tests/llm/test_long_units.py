import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from vocabloom.llm import curve_packing, piece_codec, run_table


def letters(n, seed=2):
    return "".join(map(chr, np.random.default_rng(seed).integers(97, 123, n)))


@pytest.mark.parametrize("text", [letters(1_000_000), "日本語" * 40_000, "ACGT" * 40_000, "a" * 100_001, letters(300) + " x\n" + letters(70)])
def test_text_without_spaces(text):
    """A unit of a million characters is encoded like the library does, in seconds."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    model = piece_codec.load(path)
    ids = model.encode(pa.array([text, "a b"]))
    assert ids[0].tolist() == library.encode(text, add_bos=True, add_eos=True)
    assert model.decode(ids) == library.decode([x.tolist() for x in ids])


def test_long_word_of_the_packer():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, words = Tokenizer.from_file(path), [letters(200_000), "short", letters(65), "ab" * 40, "x-" * 300]
    ids, lengths = curve_packing.WordTokenizer(path).encode(words)
    ends = np.cumsum(lengths)
    for word, a, b in zip(words, ends - lengths, ends):
        assert ids[a:b].tolist() == library.encode(word, add_special_tokens=False).ids


def test_both_agendas_agree(monkeypatch):
    rng = np.random.default_rng(4)
    pairs, symbol = {}, 3
    for rank in range(12):
        a, b = rng.integers(0, symbol, 2).tolist()
        pairs.setdefault((a, b), (rank // 2, symbol))
        symbol += 1
    agenda = run_table.PairAgenda(pairs)
    lengths = rng.integers(0, 60, 200)
    symbols = rng.integers(0, 3, int(lengths.sum()))
    together = agenda.run(symbols, lengths)
    monkeypatch.setattr(run_table, "LONG", 5)
    alone = agenda.run(symbols, lengths)
    assert together[0].tolist() == alone[0].tolist() and together[1].tolist() == alone[1].tolist()


def test_run_table_forgets():
    table = run_table.RunTable(lambda words: (np.arange(sum(map(len, words))) % 7, np.array([len(w) for w in words])), most=10, most_tokens=20)
    for words in (["a", "bb"], ["c" * 30], ["a", "dd", "bb"], [f"w{i}" for i in range(9)]):
        runs, lengths = table.tokens(words, np.arange(len(words)))
        assert lengths.tolist() == [len(w) for w in words] and len(runs) == sum(map(len, words))
