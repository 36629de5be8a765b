"""Training-data operators: language ID, decontamination, licence scans, near-duplicates, shards,
quality, pseudonyms, byte-pair encoding and language-model scores.  Nothing else in the library
imports this subpackage."""
