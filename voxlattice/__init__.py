"""voxlattice: Spark-native preparation of speech corpora (indexes, subtitles, transcripts, audio)."""
