"""corpusmill.streaming"""
