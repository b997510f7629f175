"""Training-data operators: near-duplicates, url and quality filters, extraction,
toxicity, language-model scores, token counts, byte BPE, Jaccard joins, mixing."""
