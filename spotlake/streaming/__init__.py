"""spotlake.streaming"""
