"""Extensions for streams: the batch operators that need no more than one pass or a windowed count."""
