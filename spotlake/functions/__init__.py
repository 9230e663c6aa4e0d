"""spotlake.functions"""
