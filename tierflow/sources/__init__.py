"""Reading and writing files: landing, bad-record policies, compaction, load audit."""
