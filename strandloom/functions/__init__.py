"""Column expressions: identifiers, chromosomes, DNA, quality strings and alignments."""
