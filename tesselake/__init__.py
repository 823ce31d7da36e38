"""A PySpark-native engine for large collections of audio, feature and text files."""
