"""corpusmill.sources"""
