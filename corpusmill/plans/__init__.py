"""corpusmill.plans"""
