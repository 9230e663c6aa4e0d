"""spotlake.sources"""
