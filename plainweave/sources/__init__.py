"""Reading corpora, texts and results; writing them."""
