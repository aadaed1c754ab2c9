"""Operators of a training-data pipeline over `documents` and `conversations`.

Nothing else in the library imports this subpackage.

quality       line-first cleaning and document rejection
line_dedup    repeated lines, by levelled sorted runs of line hashes
simhash       near duplicates, by a byte-position inverted index
mixing        sources to target weights, by Poisson replication
packing       token sequences, by exact complements and best fit
language      language identification, by rank-order n-gram profiles
chat          chat records of any known layout as canonical, masked turns
suffix_dedup  repeated byte strings, by a run-length index
phrases       Lempel-Ziv phrase fingerprints
katz          Katz backoff language-model scores
queries       each as a registered query, with SQL where SQL can express it
"""
