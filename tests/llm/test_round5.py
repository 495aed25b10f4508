"""Words of texts for a tokenizer, and lines of large groups."""

from __future__ import annotations

import public_tokenizers
import pytest

from ledgerline.llm import rans


@pytest.mark.parametrize("text", ["a.b/c@d x'll, y_z' 'sto", "É,x ß… é́, ×, 7up! 5%%a", "a̸< <|x|> a<b> \x1ca, è.", "Σίσυφος, ΣΑΣ. İ, ﬁ;"])
def test_words_end_before_punctuation_and_ids_stay(text):
    tokens = rans.WordTokens(public_tokenizers.path("word_bpe_49k.json"))
    assert tokens.encode([text.encode()], 2)[0].tolist() == [*tokens.tokenizer.encode(text, add_special_tokens=False).ids, 2]
    assert len(rans.split_words(["ab#cd ab&, ab é% ab".encode()])[0].unique()) == 5  # ab, #cd, &,, é and %
