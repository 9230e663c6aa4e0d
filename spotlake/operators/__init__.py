"""spotlake.operators"""
